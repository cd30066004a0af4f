"""Each stage of the pipeline against a plain restatement, on the result its predecessor kept."""

import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from gazette.llm.common import table
from gazette.llm.packing import encoder

SF = "/root/testdata/sf0.01"


def shingles(t):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    return Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        if name != "pack":
            assert after.columns == docs.columns
        kept[name] = (docs.toPandas(), after.toPandas())
        docs = after
    before, after = kept["language_id"]
    assert set(after.doc_id) == {i for i, t in zip(before.doc_id, before.text) if t and any(c.isalpha() for c in t)}
    before, after = kept["exact_dedup"]
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)     # noqa: E731
    groups = defaultdict(list)
    for i, t in zip(before.doc_id, before.text):
        groups[low(t)].append(i)
    assert sorted(after.doc_id) == sorted(max(g) for g in groups.values())
    before, after = kept["near_dedup"]
    sets = {i: shingles(t) for i, t in zip(before.doc_id, before.text)}
    gone = set(before.doc_id) - set(after.doc_id)
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)

    def nearest(i):
        c = Counter(j for x in sets[i] for j in holders[x] if j != i)
        return max(((sum((sets[i] & sets[j]).values()) / sum((sets[i] | sets[j]).values()), j) for j, _ in c.most_common(20)), default=(0, None))
    assert gone and all(nearest(i)[0] > 0.74 for i in gone)                     # plain Jaccard is near the weighted one
    assert all(nearest(i)[0] < 0.88 for i in after.doc_id if nearest(i)[1] in set(after.doc_id))
    before, after = kept["source_mix"]
    times = Counter(after.doc_id)
    assert set(times) <= set(before.doc_id) and set(times.values()) <= {1, 2}
    words = {i: len(t.split()) for i, t in zip(before.doc_id, before.text)}
    total = sum(words.values())
    assert abs(sum(words[i] * n for i, n in times.items()) - 1.5 * total) < 0.01 * total
    before, after = kept["pack"]
    e = encoder(corpus_pipeline.TOKENIZER)
    ids = {i: e.whole(t) + b"\0\0\0\0" for i, t in zip(before.doc_id, before.text)}
    tokens = sum(len(ids[i]) // 4 * n for i, n in times.items())
    assert after.length.sum() == tokens
    assert all(zlib.crc32(ids[r.doc_id][4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32 for r in after.itertuples())
    assert after.sequence_id.nunique() <= 1.03 * tokens / 2048 + 1


def test_run_equals_the_stages(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0
