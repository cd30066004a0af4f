"""Landed sources: feed documents with missing elements, crafted web pages."""

from pyspark.sql import functions as F

from gazette.functions import html as H
from gazette.operators import ingest
from gazette.session import scratch_path
from gazette.sources import feeds as FS


def test_feed_scan_defaults(spark):
    path = scratch_path(spark, "feeds-defaults")
    items = ["<item><pos>1</pos><title>Hello</title><link>https://a/1</link><description>d</description></item>",
             "<item><pos>2</pos><link>https://a/2</link></item>",
             "<item><pos>3</pos><title>No link</title></item>"]
    spark.createDataFrame([("<channel>" + "".join(items) + "</channel>",)], "value string") \
        .coalesce(1).write.text(f"{path}/feed=src1")
    got = {r.entry_pos: (r.feed, r.title, r.link, r.summary) for r in FS.feed_scan(spark, path).collect()}
    assert got == {1: ("src1", "Hello", "https://a/1", "d"), 2: ("src1", "Untitled", "https://a/2", ""),
                   3: ("src1", "No link", "", "")}


def test_page_body_rules(spark):
    long_p = "word " * 100
    pages = [
        (1, "<html><head><title>T &amp; U</title><script>var x='<p>no</p>';</script></head><body>"
            "<nav><a>menu</a></nav><article><h1>Head</h1><p>One &lt;b&gt; two</p><!-- c -->"
            f"<p>{long_p}</p><style>p{{}}</style></article><footer>foot</footer></body></html>"),
        (2, "<html><body><div>Only body</div><p>second &quot;line&quot;</p></body></html>"),
        (3, "<html><head><title>Short</title></head><body><article><p>tiny</p></article></body></html>"),
    ]
    df = spark.createDataFrame(pages, "page_id int, html string").select(
        "page_id", H.page_body("html").alias("body"), H.page_title("html").alias("fallback"))
    rows = {r.page_id: r for r in ingest.body_or_fallback(df, "body", "fallback").collect()}
    assert rows[1].body == "Head\nOne <b> two\n" + long_p.strip()
    assert rows[1].has_full_text and rows[1].text == rows[1].body
    assert rows[2].body == 'Only body\nsecond "line"'
    assert not rows[3].has_full_text and rows[3].text == "Short"


def _land(spark, path, feed, *items):
    spark.createDataFrame([("<channel>" + "".join(items) + "</channel>",)], "value string") \
        .coalesce(1).write.mode("append").text(f"{path}/feed={feed}")


def _item(pos, title="t"):
    return f"<item><pos>{pos}</pos><title>{title}</title><link>l{pos}</link></item>"


def test_broken_items_leave_their_neighbours(spark):
    path, store = scratch_path(spark, "feeds-broken"), scratch_path(spark, "feeds-broken-store")
    _land(spark, path, "a", _item(1), "<item><pos>2</pos><title>no end</item>", _item(3), _item("four"), _item(5, "x & y"), _item(6), "<item><pos>8</pos>", _item(9, "a &lt;b&gt;"))
    _land(spark, path, "b", _item(7))
    assert FS.scan_new(spark, path, store) == [0]
    got = sorted((r.feed, r.entry_pos, r.title) for r in FS.scanned_entries(spark, store).collect())
    assert got == [("a", 1, "t"), ("a", 3, "t"), ("a", 6, "t"), ("a", 9, "a <b>"), ("b", 7, "t")]
    bad = FS.rejected_items(spark, store).collect()
    assert len(bad) == 4 and {r.feed for r in bad} == {"a"} and any("four" in r.item for r in bad) and all("feed=a" in r.file for r in bad)


def test_a_scan_reads_new_files_only(spark):
    import os
    path, store = scratch_path(spark, "feeds-inc"), scratch_path(spark, "feeds-inc-store")
    _land(spark, path, "a", _item(1), _item(2))
    assert FS.scan_new(spark, path, store) == [0] and FS.scan_new(spark, path, store) == []
    _land(spark, path, "a", _item(3))
    _land(spark, path, "c", _item(4))
    assert FS.scan_new(spark, path, store) == [1]
    rows = FS.scanned_entries(spark, store)
    assert sorted((r.scan, r.feed, r.entry_pos) for r in rows.collect()) == [(0, "a", 1), (0, "a", 2), (1, "a", 3), (1, "c", 4)]
    assert sorted(r.entry_pos for r in rows.where("scan = 1").collect()) == [3, 4]
    assert os.path.isdir(f"{store.removeprefix('file:')}/checkpoint")
