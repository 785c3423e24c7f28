"""Guards that raise, limits, and sinks, on small tables."""

import json
import pathlib

import pytest
from pyspark.sql import functions as F

from evidentia.functions import parse, urls
from evidentia.operators import checks, reconcile
from evidentia.sources import readers


def test_errors_stop_and_warnings_do_not(spark):
    rows = spark.createDataFrame([(1, None), (2, "x")], "id long, name string")
    error = checks.Check("blank", "names", "error", checks.blank(rows, "id", "name"))
    warning = checks.Check("blank", "names", "warning", checks.blank(rows, "id", "name"))
    with pytest.raises(checks.ChecksFailed) as found:
        checks.enforce([error, warning])
    assert [(r["category"], r["check_name"], r["n"]) for r in found.value.counts] == [("names", "blank", 1)]
    checks.enforce([warning])
    assert [(r.check_name, r.cnt) for r in checks.warning_counts([error, warning]).collect()] == [("blank", 1)]


def test_unknown_names_raise(spark):
    rows = spark.createDataFrame([(1, "x")], "a long, b string")
    assert reconcile.renamed(rows, {"a": "c", "z": "y"}).columns == ["c", "b"]
    for call in (lambda: reconcile.renamed_strictly(rows, {"z": "y"}), lambda: reconcile.without(rows, "z"), lambda: reconcile.replaced(rows, z=F.lit(1))):
        with pytest.raises(ValueError):
            call()


def test_limits_report_what_they_withhold(spark):
    rows = spark.createDataFrame([(k,) for k in range(7)], "k long")
    top = reconcile.top_withheld(rows, [F.desc("k")], 3).orderBy("place").collect()
    assert [(r.k, r.place, r.withheld) for r in top] == [(6, 1, 4), (5, 2, 4), (4, 3, 4)]
    assert {r.withheld for r in reconcile.top_withheld(rows, [F.desc("k")], 0).collect()} == {0}
    assert reconcile.top_withheld(rows, [F.desc("k")], -1).count() == 7


def test_lines_keep_every_key_and_none_may_vanish(spark, tmp_path):
    rows = spark.createDataFrame([(2, None), (1, "x")], "id long, name string")
    readers.write_jsonl(rows, str(tmp_path / "one"), "id", one_file=True)
    (file,) = pathlib.Path(tmp_path / "one").glob("part-*")
    assert [json.loads(line) for line in file.read_text().splitlines()] == [{"id": 1, "name": "x"}, {"id": 2, "name": None}]
    assert sorted(map(tuple, readers.strict_jsonl(spark, str(tmp_path / "one"), rows.schema).collect())) == [(1, "x"), (2, None)]
    wider = spark.createDataFrame([], "id long, name string, gone string").schema
    with pytest.raises(ValueError):
        readers.strict_jsonl(spark, str(tmp_path / "one"), wider)


def test_every_form_of_a_patent(spark):
    names = ["U.K. Patent 1,234", "GB1234567", "Patente de invencion 71,234", "Patent No. D96,384", "Design Patent", "Drawing D96384", "Listing #1,925,018 [Ball]", "rugby patent", None]
    rows = spark.createDataFrame(list(enumerate(names)), "k long, name string").select("k", parse.patent(F.col("name")).alias("p")).orderBy("k").select("p.*").collect()
    assert [(r.jurisdiction, r.is_design, r.number, r.title) for r in rows[:8]] == [
        ("GB", False, "1234", None), ("GB", False, "1234567", None), ("ES", False, "71234", None), ("US", True, "D96384", None),
        ("US", True, "D", None), ("US", True, "D96384", None), ("US", False, "1925018", "Ball"), ("US", False, None, None),
    ]


def test_tracking_parameters_go_in_any_case(spark):
    given = ["http://a.org/?utm_reader=1&msclkid=2&_ga=3&ref=x", "a.org/p/?UTM_SOURCE=1&b=2&a=1#f", "https://a.org/?utm_=1"]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(given)), "k long, u string").orderBy("k").select(urls.normalize(F.col("u"))).collect()]
    assert got == ["http://a.org/?ref=x", "https://a.org/p?a=1&b=2", "https://a.org/?utm_=1"]


def test_branches_need_their_literals(spark):
    rows = spark.createDataFrame([("ok", "foo(a|b)?|bar", ["foo", "bar"]), ("bad", "foo|baz", ["foo", "Bar"])], "name string, pattern string, needles array<string>")
    assert sorted(r.detail for r in checks.uncovered_branches(rows, "name", "pattern", "needles").collect()) == ["bad: Bar", "bad: baz"]


def test_every_form_of_a_company_an_article_and_nobody(spark):
    rows = spark.createDataFrame([("Foo (Europe) (1950-1960)",), ("Foo (Europe), of Ghent, (1971) [Trade Name: F]",), ("A-B (1980)",)], "t string").select(parse.company(F.col("t")).alias("c")).select("c.*").collect()
    assert [tuple(r) for r in rows] == [("Foo (Europe)", None, "Foo (Europe)", None, 1950, 1960, None), ("Foo (Europe)", "F", "F", "Ghent", None, None, 1971), ("A-B", None, "A-B", None, None, None, None)]
    names = ["Expo 1991 Factory Tour (Coin Slot, Spring 1992, pages 21-22)", "Article (March 1992)", "Ad Mar.1975", "Play Meter Magazine Article, page 7", None]
    rows = spark.createDataFrame([(n,) for n in names], "t string").select(parse.article(F.col("t")).alias("a")).select("a.*").collect()
    assert [tuple(r) for r in rows] == [(None, "21-22", None), (None, None, "March 1992"), (None, None, "Mar.1975"), ("Play Meter", "7", None), (None, None, None)]
    people = ["Missing", "TBA", "null", "UNDEFINED", "Various", "not known", "Ann Undisclosed", "Ann (Undisclosed)", "Unknown Soldier"]
    kept = spark.createDataFrame([(n,) for n in people], "t string").where(parse.is_person(F.col("t"))).collect()
    assert [r.t for r in kept] == ["Various", "not known", "Ann Undisclosed"]


def test_marks_of_no_content_whatever_their_case():
    from evidentia.sources.html import marked_content

    assert marked_content("a<!-- GoogleOff: ALL -->b<!--GOOGLEON: all-->c<!-- googleoff: index -->d") == "acd"
