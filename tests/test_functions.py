"""Column functions on hand-made rows, dialect traps included."""

import pytest
from pyspark.sql import functions as F

from evidentia.functions import parse, text, urls
from evidentia.operators import navigate, search
from evidentia.operators.components import connected_components
from evidentia.sources.html import parse_page
from evidentia.sources import readers


def one(spark, column, *values, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, x {kind}")
    return [r[0] for r in rows.orderBy("k").select(column(F.col("x"))).collect()]


def test_header_line(spark):
    got = one(spark, lambda x: parse.header_line(x, r"Cat No\."), "Cat No. 5755 / 2011 / 4 Players", "Cat No. 1 / March 21, 1961", "Cat No. 2 / August, 1941 / 1 Player", "Cat No. 3", "Cat No. 4 / soon", "Cat No. 3\n", "Cat No. 9 / Mar, 1950", None)
    assert [(r.number, r.players, r.year, r.month, r.day) for r in got] == [
        (5755, 4, 2011, None, None), (1, None, 1961, 3, 21), (2, 1, 1941, 8, None), (3, None, None, None, None),
        (None,) * 5, (None,) * 5, (9, None, None, None, None), (None,) * 5,
    ]


def test_company(spark):
    got = one(spark, parse.company, "Acme, of Town, State (1976-1983) [Trade Name: X]", "Solo (1971)", "Two-Part (1980)", "Plain,", "A (1990) (1991)", None)
    assert tuple(got[0]) == ("Acme", "X", "X", "Town, State", 1976, 1983, None)
    assert (got[1].company_name, got[1].single_year) == ("Solo", 1971)
    assert (got[2].company_name, got[2].single_year) == ("Two-Part", None)
    assert got[3].company_name == "Plain"
    assert got[4].company_name == "A (1991)"  # the first match alone is replaced
    assert got[5].company_name is None


def test_partial_dates(spark):
    got = one(spark, parse.partial_date, "March 5, 1961", "Aug, 1941", "1999", "Foo, 1941", "August 1941", None)
    assert [(r.iso, r.precision) for r in got[:3]] == [("1961-3-5", "day"), ("1941-8", "month"), ("1999", "year")]
    assert got[3].year is None and got[4].iso == "1941-8" and got[5].year is None


def test_small_parsers(spark):
    assert one(spark, parse.slug, "Éclair  & Co.!") == ["eclair-co"]
    assert tuple(one(spark, parse.game_reference, "Maker’s 1990 ‘Title’")[0]) == ("Maker", 1990, "Title")
    assert tuple(one(spark, parse.game_reference, "Just A Title")[0]) == (None, None, "Just A Title")
    assert one(spark, parse.aliases_of, "A part. Also called Zed. Also known as the Able; also called zed.") == [["Able", "Zed"]]
    assert tuple(one(spark, parse.production, "1,234 units (confirmed)")[0]) == (1234, "confirmed", False)
    assert tuple(one(spark, parse.rating, "7.4/10 (12 ratings/3 comments)")[0])[:3] == (7.4, 12, 3)
    assert one(spark, lambda x: parse.infobox(x, "system"), "{{x\n| system = [[A|B]] C\n|y=1}}") == ["B C"]
    assert one(spark, parse.is_person, "A. B", "?", "(undisclosed)", None) == [True, False, False, None]
    assert one(spark, parse.publisher_prefix, "Acme_Toys_1979_x.pdf", "1979_x") == ["Acme_Toys", None]
    assert one(spark, parse.container, "a.PDF", "noext", "a.toolong") == ["pdf", None, None]


@pytest.mark.parametrize(
    "raw,want",
    [
        ("HTTP://Example.COM:80/a/?b=2&a=1&utm_source=x#top", "http://example.com/a?a=1&b=2"),
        ("example.com", "https://example.com/"),
        ("https://u:P@Host/", "https://u:P@host/"),
        ("https://h/p?ref=x", "https://h/p?ref=x"),
        ("  ", None),
    ],
)
def test_normalize_url(spark, raw, want):
    assert one(spark, urls.normalize, raw) == [want]


def test_urls(spark):
    assert one(spark, urls.extension, "https://h/a.b/c.PDF?x=1", "https://h/a", "https://h.com/") == ["pdf", "", ""]
    assert one(spark, urls.capture_date, "https://web.archive.org/web/20200102030405id_/http://x/") == ["2020-01-02"]
    assert one(spark, urls.canonical_video, "https://youtu.be/abcdefg", "https://h/") == ["https://www.youtube.com/watch?v=abcdefg", None]
    base = F.lit("https://h/a/b?c")
    assert one(spark, lambda x: urls.resolve(x, base), "d", "/e", "//k/f", "mailto:x", "?q") == ["https://h/a/d", "https://h/e", "https://k/f", None, "https://h/a/b?q"]


def test_text(spark):
    assert one(spark, text.sentences, "One. Two!  Three?\n\nFour\fFive. ") == [["One.", "Two!", "Three?", "Four", "Five."]]
    assert one(spark, text.match_form, "  “Smart”\n ‘q’  X ") == ["\"smart\" 'q' x"]
    assert one(spark, text.tokens, "Été_de 42's") == [["ete", "de", "42", "s"]]
    assert one(spark, text.search_units, 'a "b c" d"e', '"open run', "  ") == [["a", "b c", "d", "e"], ["open run"], []]
    assert one(spark, text.plain_text, "﻿a\r\nb\rc\fd", "\x00", "  ") == ["a\nb\nc\nd", None, None]


def test_lines_pages_and_quotes(spark):
    doc = "---\nmeta\n---\n# A\nfirst of\nthe two\n```\n# not\n```\n## B\nx\n\f\ny of the z\n\f\n"
    docs = spark.createDataFrame([("u", doc)], "url string, text string")
    lines = navigate.lines_table(docs, frontmatter=True)
    heads = [r.heading for r in lines.where("heading is not null").orderBy("line_no").collect()]
    assert heads == ["A", "B"]
    assert {r.section for r in lines.where("line_no < 3").collect()} == {"metadata"}
    pages = {r.page_no: r.text for r in navigate.page_blocks(lines).collect()}
    assert set(pages) == {1, 2} and pages[2].startswith("y of the z")
    spans = sorted((r.first_line, r.last_line) for r in navigate.needle_lines(lines, "OF  the").collect())
    assert spans == [(4, 5), (12, 12)]
    windows = sorted((r.first_line, r.last_line, r.matches) for r in navigate.quote_windows(lines, "of the", 1).collect())
    assert windows == [(3, 6, 1), (11, 13, 1)]
    got = {r.heading: (r.line_no, r.end_line) for r in navigate.sections(lines).collect()}
    assert got["A"][0] == 3 and got["B"] == (9, 14) and got["A"][1] == 14


def test_transcript(spark):
    vtt = "WEBVTT\n\nNOTE x\nmore\n\n00:01.000 --> 00:02.000\n<c>Hello</c>\n\n00:02.000 --> 00:03.000\nHello\nthere\n"
    docs = spark.createDataFrame([(1, vtt)], "id int, text string")
    assert [r.line for r in navigate.transcript(docs, "id", "text").orderBy("line_no").collect()] == ["Hello", "there"]


def test_search(spark):
    docs = spark.createDataFrame([(1, "of the of the x"), (2, "the of"), (3, "nothing")], "id int, text string")
    got = {r.id: r.tf0 for r in search.phrase_hits(docs, [["of", "the"]], "id", "text").collect()}
    assert got == {1: 2, 2: 0, 3: 0}
    assert [r.id for r in search.bm25(docs, [["nothing"]], "id", "text").collect()] == [3]


def test_page():
    page = parse_page("<title>T &amp; U</title><script>x</script><h1>H<p>a<b>b<a href='/l'>L <i>k</i></a><li>c")
    assert page["title"] == "T & U" and page["links"] == [{"href": "/l", "anchor": "L k", "pos": 0}]
    assert "x" not in (page["body"] or "") and "- c" in page["body"]
    assert parse_page(None)["body"] is None
    assert parse_page("<div>a<svg><path></div><p>b")["body"] == "a\n\nb"  # the end of what holds it ends an element that never closes
    assert parse_page('<p>a</p><div id="onetrust-x"><p>take <b>all</b></p><a href="/y">y</a></div><p>b')["body"] == "a\n\nb"
    assert parse_page('<div class="big cky-modal">no</div>c<div class="cookies">d</div>')["body"] == "c\n\nd"
    assert parse_page("a<!-- googleoff: all --><p>x<!--googleon: all-->b<!--googleoff: index -->c")["body"] == "abc"


def test_sniff(spark):
    rows = spark.createDataFrame([(bytearray(b"%PDF-1"), "text/html"), (bytearray(b"RIFFxxxxWEBP"), ""), (bytearray(b"RIFFxxxxWAVE"), ""), (bytearray(b"hi"), "text/plain;x")], "c binary, d string")
    assert [r[0] for r in rows.select(readers.sniff(F.col("c"), F.col("d"))).collect()] == ["pdf", "webp", None, "text"]


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 9), (10, 11), (7, 7), (None, 2), (11, 10)]
    got = {(r.node, r.component) for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {(3, 3), (4, 3), (5, 3), (9, 3), (10, 10), (11, 10)}
    chain = spark.range(1, 200).selectExpr("id as src", "id - 1 as dst")
    assert {r.component for r in connected_components(chain).collect()} == {0}
    assert connected_components(chain.limit(0)).count() == 0


def test_json_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"LastRefreshDateUtc": "2020-01-01T00:00:00", "Data": [{"id": 1, "x": "a"}]}')
    (tmp_path / "b.json").write_text('{"LastRefreshDateUtc": "2021-01-01T00:00:00", "Data": [{"id": 1, "y": 2}, {"id": 2}]}')
    got = readers.snapshots(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")])
    assert got.count() == 3 and set(got.columns) == {"snapshot_utc", "id", "x", "y"}
    (tmp_path / "w.tsv").write_text("# c\n\nhttp://a\tq r\nhttp://b\n")
    assert sorted(map(tuple, readers.work_list(spark, str(tmp_path / "w.tsv")).collect())) == [("http://a", "q r"), ("http://b", None)]
    out = str(tmp_path / "o")
    readers.write_jsonl(spark.createDataFrame([(2, None), (1, "x")], "id int, v string"), out, "id")
    assert '"v":null' in "".join(r.value for r in spark.read.text(out).collect())
    assert readers.or_empty(spark, str(tmp_path / "none"), spark.range(1).schema).count() == 0


def test_long_documents_in_linear_time(spark):
    """A document of 100,000 lines with as many hits and thousands of headings is placed without comparing all with all."""
    from pyspark.sql import functions as F

    from evidentia.operators import navigate

    body = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(100_000)), lambda i: F.when(i % 20 == 0, F.concat(F.repeat(F.lit("#"), (i / 20 % 3 + 1).cast("int")), F.lit(" Part "), i)).when(i % 2 == 0, "see of").otherwise("the end")), "\n")
    docs = spark.range(1).select(F.lit("u").alias("url"), body.alias("text"))
    lines = navigate.lines_table(docs)
    hits = navigate.needle_lines(lines, "of the")
    assert hits.count() == 45_000  # each runs over a line's end
    assert hits.where("last_line = first_line + 1").count() == 45_000
    entries = navigate.paged_outline(lines)
    assert entries.agg(F.sum("n")).first()[0] == 5_000
    deep = entries.where("level = 3").orderBy(F.desc("line_no")).first()
    assert deep.path.count(" > ") == 1 and deep.withheld == 0
