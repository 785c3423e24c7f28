"""Many patterns in one pass, the class graph as literals, credits and spellings that expire."""

import datetime as dt

from pyspark.sql import functions as F

from evidentia.functions import vocabulary as voc
from evidentia.operators import classify, credits
from evidentia.plans import vocabularies


def test_automaton_equals_each_pattern(spark):
    """All patterns over odd names give what each pattern gives alone, with one scan and one pass of the automaton."""
    names = [None, "", "MANUAL", "remanualed", "rom", "prom rom", "sound chip u1", "a ROM set", "owner s manual manual", "x" * 10_000 + " flyer", "coil chart coil list"] + [f"{k} {n}" for k in vocabularies.KINDS for n in ("", "x")]
    rows = spark.createDataFrame([(i, n, c) for i, n in enumerate(names) for c in (None, "pdf", "zip")], "i int, name string, container string").withColumn("name", F.lower("name"))
    many = classify.classify_many(rows, voc.CLASS_PATTERNS, "name", "container")
    each = rows.withColumn("classes", classify.class_list(voc.CLASS_PATTERNS, "name", "container"))
    assert sorted(many.collect(), key=str) == sorted(each.collect(), key=str)
    assert classify.classify_many(rows.limit(0), voc.CLASS_PATTERNS, "name", "container").count() == 0


def test_one_scan(spark, sf):
    plan = vocabularies.vocabulary_texts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan and "Join" not in plan


def test_vocabulary_holds_together(spark):
    """Every emitted class is named, every parent too, and every pattern's branches have a needle of their own."""
    named = {c for c, _ in voc.classes()}
    assert {p[0] for p in voc.CLASS_PATTERNS} <= named and {x for e in voc.CLASS_PARENTS for x in e} <= named
    assert len({p[1] for p in voc.CLASS_PATTERNS}) == len(voc.CLASS_PATTERNS) == 51
    assert voc.relation(spark, "credit_roles").select(F.explode("labels")).distinct().count() == 9
    assert voc.relation(spark, "displays").count() == 6 and voc.relation(spark, "technology").count() == 3


def test_closure_as_literals(spark):
    edges = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")]
    assert classify.closed(edges) == {"a": ["b", "c"], "b": ["c"], "x": ["x", "y"], "y": ["x", "y"]}
    pairs = {(r.child, r.ancestor) for r in classify.closure(spark.createDataFrame(edges, "child string, parent string")).collect()}
    assert pairs == {(c, p) for c, above in classify.closed(edges).items() for p in above}
    rows = spark.createDataFrame([(["a", "x"],), ([],), (["lone"],)], "c array<string>").select(classify.rolled_up("c", classify.closed(edges)).alias("r"), classify.rolled_up("c", {}).alias("own")).collect()
    assert [r.r for r in rows] == [["a", "b", "c", "x", "y"], [], ["lone"]] and rows[0].own == ["a", "x"]


def test_spellings_that_hold(spark):
    day = lambda y, m=1: dt.date(y, m, 1)
    rows = spark.createDataFrame([(1, "x", day(1990)), (2, "x", day(1995)), (3, "x", day(1999)), (4, "x", day(2005)), (5, "z", day(2005)), (6, None, day(2005)), (7, "x", None)], "i int, label string, day date")
    spellings = spark.createDataFrame([("x", day(1992), day(1998), "old"), ("x", day(1996), None, "new"), ("x", day(2001), day(2003), "brief"), ("y", day(1900), None, "other")], "label string, since date, until date, slug string")
    got = {r.i: r.slug for r in credits.as_of(rows, spellings, "label", "day").collect()}
    assert got == {1: None, 2: "old", 3: "new", 4: None, 5: None, 6: None, 7: None}


def test_credits_of_the_archive(spark):
    fields = [r[2] for r in voc.CREDIT_ROLES if r[2]]
    models = spark.createDataFrame([(1, "Ann, ?", *[None] * 6), (2, None, *[""] * 6)], "k int, " + ", ".join(f"{f} string" for f in fields))
    pages = spark.createDataFrame([(1, [("Concept by", " Gil "), ("Design by", "Zed"), ("Concept by", "Unknown")]), (2, [])], "k int, credits array<struct<role:string,name:string>>")
    assert {tuple(r) for r in credits.credits(models, pages, "k").collect()} == {(1, "Design", "design", "Ann"), (1, "Concept", "concept", "Gil")}
