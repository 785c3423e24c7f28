"""Record operators on hand-made rows."""

from pyspark.sql import functions as F

from evidentia.operators import navigate, records


def test_ids_and_flags(spark):
    rows = spark.createDataFrame([("G1-M2-A3", "x"), ("G1-", "rel")], "t string, c string")
    assert [tuple(r[0]) for r in rows.select(records.dashed_id(F.col("t"))).collect()] == [("G1", "M2", "A3"), ("G1", None, None)]
    assert [r[0] for r in rows.select(records.is_resolvable(F.col("c"), F.col("t"), r"\AG\d+", "rel")).collect()] == [True, None]


def test_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "document_id long, title string")
    urls = spark.createDataFrame([(1, "https://h/a", "main")], "document_id long, url string, role string")
    refs = spark.createDataFrame([("2",), ("H/a/",), ("9",)], "ref string")
    refs = refs.withColumn("ref", F.when(F.col("ref") == "H/a/", "https://H/a/").otherwise(F.col("ref")))
    assert {tuple(r) for r in records.resolve_refs(refs, docs, urls).collect()} == {("2", 2), ("https://H/a/", 1)}
    changes = spark.createDataFrame([(1, None, True), (2, "x", False)], "document_id long, title string, set_title boolean")
    assert {tuple(r) for r in records.set_fields(docs, changes, ["title"]).collect()} == {(1, None), (2, None)}
    none = spark.createDataFrame([], "document_id long, document_class string, source string, hunted_at string, note string")
    got = {r.document_id: (len(r.urls), len(r.classes)) for r in records.document_records(docs, urls, none, none).collect()}
    assert got == {1: (1, 0), 2: (0, 0)}


def test_acquisition_and_migration(spark):
    urls = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    pages = spark.createDataFrame([("a",)], "url string")
    fetches = spark.createDataFrame([("b", 1, 1, 200), ("b", 2, 2, 403), ("a", 1, 3, 500)], "url string, fetched_at int, id int, http_status int")
    assert {(r.url, r.captured, r.blocked) for r in records.acquisition(urls, pages, fetches).collect()} == {("a", True, False), ("b", False, True), ("c", False, False)}
    old = spark.createDataFrame([("t", None, "ocr"), ("t", "o", "html"), ("t", None, None)], "text string, ocr_text string, text_source string")
    assert {(r.text, r.ocr_text, r.text_source) for r in records.migrated(old).collect()} == {(None, "t", None), ("t", "o", "html"), ("t", None, None)}
    caps = spark.createDataFrame([("https://h/a", "2", False), ("https://h/a/", "1", False), ("https://h/b", "3", True), ("https://k/", "1", False)], "original string, timestamp string, refused boolean")
    assert {tuple(r) for r in records.oldest_captures(caps, "https://h/").collect()} == {("https://h/a", "1", "found"), ("https://h/b", None, "refused")}


def test_sections_and_misses(spark):
    docs = spark.createDataFrame([("u", "# A\nx\n\f\n\f\n# B c\ny"), ("v", "")], "url string, text string")
    lines = navigate.lines_table(docs)
    wanted = spark.createDataFrame([("u", "b C"), ("u", "Page 1"), ("u", "page 9"), ("v", "page 1"), ("w", "A")], "url string, heading string")
    got = records.named_blocks(wanted, lines).collect()
    assert sorted((r.url, r.heading, r.tier, r.kind, r.line_no, r.text) for r in got) == [("u", "Page 1", "text", "page", 1, "# A\nx"), ("u", "b C", "text", "section", 4, "# B c\ny")]
    pages = navigate.page_blocks(lines)
    asked = spark.createDataFrame([("u", "page 1"), ("u", "page 2"), ("u", "page 9"), ("u", "A"), ("u", "B"), ("u", "zz"), ("v", "A")], "url string, heading string")
    heads = lines.where("heading is not null").select("url", "heading")
    assert {(r.url, r.heading, r.reason) for r in records.miss_reason(asked, pages, heads).collect()} == {
        ("u", "page 1", None), ("u", "page 2", "empty sheet"), ("u", "page 9", "out of range"), ("u", "A", None), ("u", "B", "near heading"), ("u", "zz", "unknown"), ("v", "A", "no text"),
    }
    assert {(r.url, r.tier) for r in records.paging_tier(pages, pages).collect()} == {("u", "text"), ("v", None)}
