"""Products that are switched off have no prompts."""

import datetime as dt

from gazette import config as C
from gazette.operators import prompts as P


def test_gates(spark):
    day = dt.date(2026, 1, 1)
    recent = spark.createDataFrame([(day + dt.timedelta(days=k), 1, "t", "s", "src") for k in range(3)],
                                   "day date, pos long, title string, summary string, source string")
    picks = spark.createDataFrame([("t", "body", False)], "title string, text string, long_form boolean")
    on, off = C.Settings(), C.Settings(editor_brief=False, deep_read=False, quiz_questions=0)
    for build, source, n in ((P.brief_prompt, recent, 3), (P.quiz_prompt, recent, 2), (P.deep_prompt, picks, 1)):
        assert build(source, on).count() == n and build(source, off).count() == 0
