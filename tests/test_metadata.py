"""Head metadata, carriers' overlay and re-extraction on hand-made rows."""

from pyspark.sql import functions as F

from evidentia.sources import metadata, tables


def test_head_and_frontmatter(spark):
    html = "<meta name=author content='Bo'><title> A\n title </title><meta property='og:title' content='A title'><meta name='twitter:title' content='a title'><meta name=author content=''><meta name=robots content=x><svg><title>not this</title></svg>"
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>x")], "page_id int, html string")
    row = metadata.head_metadata(tables.tag_stream(pages)).collect()
    assert [(r.page_id, r.title_tag, r.og_title, r.lines) for r in row] == [(1, "A title", "A title", ["title: A title", "author: Bo", "twitter:title: a title"])]
    texts = spark.createDataFrame([(["a: b"], "body"), ([], "body"), (["a: b"], None), (None, ""), (None, None)], "lines array<string>, body string").select(metadata.frontmatter(F.col("lines"), F.col("body")).alias("t")).collect()
    assert [r.t for r in texts] == ["---\na: b\n---\n\nbody", "body", "---\na: b\n---", None, None]


def test_overlay_and_outcomes(spark):
    extracted = spark.createDataFrame([("a", "x", "1"), ("b", "x", None), ("c", None, None)], "url string, title string, day string")
    carrier = spark.createDataFrame([("a", "y", None), ("a", "z", None), ("b", None, "2")], "url string, title string, day string")
    got = {r.url: tuple(r)[1:] for r in metadata.overlay(extracted, carrier, "url", ["title", "day"]).collect()}
    assert got == {"a": ("y", "1", "carrier", "extracted"), "b": ("x", "2", "extracted", "carrier"), "c": (None, None, None, None)}
    asked = spark.createDataFrame([(u,) for u in "abcde"], "url string")
    tracks = spark.createDataFrame([("a", "s"), ("b", None), ("c", "s"), ("d", "s")], "url string, track_sha string")
    held = spark.createDataFrame([("a", "s"), ("b", "s"), ("c", "t"), ("e", "s")], "url string, content_sha string")
    outcomes = {r.url: (r.outcome, r.http_status) for r in metadata.carrier_outcomes(asked, tracks, held).collect()}
    assert outcomes == {"a": ("unchanged", 200), "b": ("no track", 200), "c": ("changed", 200), "d": ("new", 200), "e": ("failed", None)}


def test_a_second_run_touches_nothing(spark):
    """Each content is extracted once however many pages share it; afterwards none is due."""
    pages = spark.createDataFrame(
        [(1, "s", "html", "v1", "old"), (2, "s", "html", None, "NEW"), (3, "s", "manual", "v1", "hand"), (4, "gone", "html", "v1", "old"), (5, "z", "html", "v1", "old"), (6, "e", "html", "v1", "old"), (7, "s", "html", "v2", "old"), (8, None, "html", "v1", None)],
        "url int, content_sha string, text_source string, extractor string, text string",
    )
    blobs = spark.createDataFrame([("s", "new"), ("s", "new"), ("z", "a\x00b"), ("e", " "), ("unused", "u")], "content_sha string, content string")
    seen = spark.sparkContext.accumulator(0)

    def extract(due):
        sizes = due.count()
        seen.add(sizes)
        return due.select("content_sha", F.upper(F.trim("content")).alias("text"))

    first = metadata.reextract(pages, blobs, extract, "v2")
    assert {r.url: (r.outcome, r.text, r.extractor) for r in first.collect()} == {
        1: ("rewritten", "NEW", "v2"), 2: ("unchanged", "NEW", "v2"), 3: ("manual", "hand", "v1"), 4: ("missing blob", "old", "v1"), 5: ("undecodable", "old", "v2"),
        6: ("empty", "old", "v2"), 7: ("current", "old", "v2"), 8: ("missing blob", None, "v1"),
    }
    assert seen.value == 2
    again = metadata.reextract(first.drop("outcome"), blobs, extract, "v2")
    assert seen.value == 2  # nothing was left to read
    assert {r.outcome for r in again.collect()} == {"current", "manual", "missing blob"}
