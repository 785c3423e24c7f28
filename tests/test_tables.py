"""Labelled tables, glossaries and charsets on hand-made pages."""

from pyspark.sql import functions as F

from evidentia.plans import models
from evidentia.sources import tables

PAGE = """<table><tr><td><b>Fire</b> <a href="m.cgi?id=12">Cat No. 12</a> <i>/ 1987 / 4 Players</i></td></tr>
<tr><td><b>Maker:</b></td><td>Acme <a href="x">X</a></td></tr><tr><td><b>Odd label: </b><td>kept<br>two
<tr><td>plain:</td><td>no</td></tr>
<tr><td><b>Files:</b></td><td>1 MB</td><td>PDF</td><td><a href="f.pdf">Doc</a></td><td>(Ann)</td></tr>
<tr><td></td><td>2 MB</td><td>ZIP</td><td><a href="g.zip">Rom</a></td><td></td></tr><tr><td></td><td></td><td></td><td>withheld</td><td></td></tr></table>"""


def test_labelled_table(spark):
    pages = spark.createDataFrame([(1, "https://h/m.cgi?id=12", PAGE), (2, "https://h/m.cgi?id=13", PAGE), (3, "https://h/x", "<p>see <a href='m.cgi?id=12'>Cat No. 12</a>"), (4, "https://h/z", None), (5, "https://h/zz?id=12", PAGE)], "page_id int, url string, html string")
    rows = tables.cell_rows(pages)
    heads = tables.page_header(rows, r"id=(\d+)", "Cat No.")
    assert {(r.page_id, r.name, r.number) for r in heads.collect()} == {(1, "Fire", 12), (2, "Fire", 12), (5, "Fire", 12)}
    fields = {r.label: (r.value, r.anchors) for r in tables.labelled_fields(rows).where("page_id = 1").collect()}
    assert fields == {"Maker": ("Acme X", ["X"]), "Odd label": ("kept two", []), "Files": ("1 MB PDF Doc (Ann)", [])}
    got = [(r.section, r.name, r.url, r.kind, r.size, r.credit) for r in tables.listings(rows).where("page_id = 1").orderBy("row_no").collect()]
    assert got == [("Files", "Doc", "f.pdf", "PDF", "1 MB", "Ann"), ("Files", "Rom", "g.zip", "ZIP", "2 MB", None)]
    named = pages.withColumn("content_sha", F.when(F.col("page_id") != 4, F.col("page_id").cast("string")))
    blobs = named.where("html is not null").select("content_sha", F.col("html").alias("content")).union(spark.createDataFrame([("9", " \n"), ("9", " \n")], "a string, b string"))
    named = named.union(spark.createDataFrame([(6, "https://h/b", None, "9")], named.schema))
    job = tables.extract_models(named, blobs, r"id=(\d+)", "Cat No.", F.regexp_extract("url", r"id=(\d+)", 1).try_cast("long"))
    assert {r.page_id: r.outcome for r in job.collect()} == {1: "ok", 2: "id differs", 3: "not a model", 4: "no blob", 5: "duplicate id", 6: "unreadable"}
    one = job.where("page_id = 1").first()
    assert (one.name, one.players, one.date, one.date_source, one.unknown) == ("Fire", 4, "1987", "header", ["Maker", "Odd label"])
    assert tables.extract_models(named.limit(0), blobs.limit(0), "x", "y", F.lit(1).cast("long")).count() == 0


def test_image_tiles_and_nested_tables(spark):
    html = """<table><tr><td><table><tr><td><b>N</b><a href="m.cgi?id=1">Cat No. 1</a></td></tr><tr><td><b>Images:</b></td><td><table><tr>
    <td><img src="/i/tn_a.jpg" alt="front"><br>Cap<br>10 x 20<br>(Bo)</td><td>no image</td><td><img src="/i/b.jpg"><br>5x6</td></tr></table></td></tr></table></td></tr></table>"""
    pages = spark.createDataFrame([(1, "u", "s")], "page_id int, url string, content_sha string")
    blobs = spark.createDataFrame([("s", html)], "content_sha string, content string")
    row = tables.extract_models(pages, blobs, r"id=(\d+)", "Cat No.", F.lit(None).cast("long")).first()
    assert row.outcome == "ok" and row.fields == {"Images": ""} and row.unknown is None
    assert [(i.url, i.caption, i.width, i.height, i.credit, i.description) for i in row.images] == [("/i/a.jpg", "Cap", 10, 20, "Bo", "front"), ("/i/b.jpg", None, 5, 6, None, None)]


def test_glossaries(spark):
    pages = spark.createDataFrame([(1, "<dl><dt>Ball<dd>Round. See Flipper<dt id=f>Flipper</dt><dd>A <b>bat</b></dd></dl>"), (2, "<h3>Gate</h3><p>One way.</p><p>More.</p>")], "page_id int, html string")
    tags = tables.tag_stream(pages)
    first = tables.glossary_terms(tags, F.col("tag") == "dt", F.col("tag").isin("dd", "b")).where("page_id = 1")
    assert {(r.term, r.definition) for r in first.collect()} == {("Ball", "Round. See Flipper"), ("Flipper", "A bat")}
    second = tables.glossary_terms(tags, F.col("tag") == "h3", F.col("tag") == "p").where("page_id = 2")
    assert [(r.term, r.definition) for r in second.collect()] == [("Gate", "One way. More.")]


def test_charset_ladder():
    assert tables.decode_bytes("é".encode("latin-1"), None) == ("é", "windows-1252", False)
    assert tables.decode_bytes("é".encode(), None)[:2] == ("é", "utf-8")
    assert tables.decode_bytes("あ".encode("cp932"), "Shift_JIS")[:2] == ("あ", "cp932")
    assert tables.decode_bytes(b"<meta charset=iso-8859-1>\xe9", "nonsense")[0].endswith("é")
    assert tables.decode_bytes(b"\x81\xff\xfe", None)[2] is True


def test_no_table_of_pages_is_broadcast(spark):
    """Sizes estimated from compressed files call every table small; a broadcast would collect the pages on the driver."""
    pages = spark.createDataFrame([(1, "https://h/m.cgi?id=12", "s")], "page_id int, url string, content_sha string")
    blobs = spark.createDataFrame([("s", PAGE)], "content_sha string, content string")
    job = tables.extract_models(pages, blobs, r"id=(\d+)", "Cat No.", F.regexp_extract("url", r"id=(\d+)", 1).try_cast("long"))
    assert [r.outcome for r in job.collect()] == ["ok"]
    plan = job._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_every_machine_page_is_read(spark, sf):
    """All stored bytes are there and read: only pages that do not say where theirs are have none."""
    _, blobs = models._machine_pages(spark, sf)
    assert blobs.count() == spark.read.parquet(f"{sf}/part.parquet").count()
    got = models.model_pages(spark, sf).select("outcome", "unknown", (F.col("page_id") % 12).alias("form"))
    assert {(r.outcome, r.unknown) for r in got.where("form = 6").collect()} == {("ok", "Cabinet Colour")}
    assert {r.form for r in got.where("outcome = 'no blob'").collect()} == {10}
