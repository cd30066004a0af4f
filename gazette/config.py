"""Run settings.

The reading-digest job is configured by a handful of scalars and two lists
(feeds, interest keywords).  They live in a frozen dataclass on the driver and
reach the executors only as literals inside column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# --- Fixed values: these must equal the reference job's constants ---------
SIMILARITY_THRESHOLD = 0.75          # title ratio at or above which two titles are "similar"
MIN_FULLTEXT_CHARS = 400             # shorter extracted bodies fall back to the feed summary
WEEKLY_MAX_ARTICLES = 60             # weekly roundup reads the first 60 articles of the week
CJK_PER_MINUTE = 350                 # reading speed, CJK glyphs per minute
LATIN_WORDS_PER_MINUTE = 220         # reading speed, Latin words per minute
CJK_PER_LINE = 32                    # glyphs on one screen line
LATIN_WORDS_PER_LINE = 12            # words on one screen line
PARAGRAPH_SPACING = 0.7              # extra lines charged per paragraph
CLIP_HEAD_SHARE = 0.65               # share of the source budget taken from the head
CLIP_MARKER = "\n\n[…]\n\n"          # elision marker between head and tail
# CJK glyph ranges counted for reading time and line cost
CJK_CLASS = "[぀-ヿ㐀-䶿一-鿿豈-﫿]"
LATIN_WORD = "[A-Za-z0-9]+"
# font variants: name, file-name suffix
FONTS = (("serif", ""), ("sans", "-sans"))
# reply token caps: article summary, quiz, brief, deep read, weekly roundup
TOKEN_CAPS = {"summary": 800, "quiz": 700, "brief": 400, "deep": 1000, "weekly": 1500}
RETRY_ATTEMPTS = 4
RETRY_BASE_DELAY_S = 20
DEFAULT_CATEGORY = "General"
DEFAULT_TITLE = "Untitled"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Defaults of the reference configuration; explicit ``None`` is kept as ``None``."""

    # These defaults must equal the reference's
    language: str = "zh-TW"
    secondary_language: str | None = None
    timezone: str = "UTC"
    max_articles_per_feed: int = 3
    summary_source_chars: int = 6000
    longform_source_chars: int = 16000
    long_form_categories: tuple[str, ...] = ("長文", "Long Reads")
    archive_retention_days: int = 60
    seen_retention_days: int = 14
    recent_retention_days: int = 14
    quiz_questions: int = 4
    paginate_articles: bool = True
    article_page_lines: int = 14
    editor_brief: bool = True
    deep_read: bool = True
    weekly_roundup: bool = True
    weekly_roundup_weekday: int = 6
    interests: tuple[str, ...] = field(default_factory=tuple)

    def __post_init__(self) -> None:
        if self.max_articles_per_feed is not None and self.max_articles_per_feed < 0:
            raise ValueError("max_articles_per_feed must be >= 0")

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)

    @classmethod
    def from_mapping(cls, conf: dict) -> "Settings":
        """Build from a parsed config mapping; missing keys take defaults, explicit nulls stay."""
        known = {f for f in cls.__dataclass_fields__}
        kw = {k: v for k, v in conf.items() if k in known}
        for k in ("long_form_categories", "interests"):
            if k in kw and kw[k] is not None:
                kw[k] = tuple(str(x) for x in kw[k])
        return cls(**kw)


# Interest keywords used with the provided test tables (their prose is
# invented European text, so the reference's own keywords would never match).
TEST_INTERESTS = ("the", "und", "tion", "enb", "pour")
TEST_SETTINGS = Settings(interests=TEST_INTERESTS)
