"""Pattern classification, class hierarchy and subject scope."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evidentia.session import cut

PATTERN_SCHEMA = "document_class string, pattern string, required_any array<string>, allow_containers array<string>, deny_pattern string"


def _tests(patterns: list[tuple], name: str, container: str | None, needed) -> list[tuple[str, Column]]:
    """(class, test) of every pattern: what `needed` says of its literals, then the regex, the containers and the denial."""
    out = []
    for i, (cls, pattern, needles, allowed, denied) in enumerate(patterns):
        test = F.col(name).rlike(pattern)
        if needles:
            test = needed(i, needles) & test
        if allowed and container:
            test = test & F.coalesce(F.col(container).isin(allowed), F.lit(False))
        if denied:
            test = test & ~F.col(name).rlike(denied)
        out.append((cls, test))
    return out


def _classes(tests: list[tuple[str, Column]]) -> Column:
    by_class: dict[str, Column] = {}
    for cls, test in tests:
        by_class[cls] = by_class[cls] | test if cls in by_class else test
    found = F.array(*(F.when(test, F.lit(cls)) for cls, test in by_class.items()))
    return F.array_sort(F.filter(found, lambda c: c.isNotNull()))


def class_list(patterns: list[tuple], name: str = "name", container: str | None = None) -> Column:
    """The sorted classes that a name matches, by a handful of `patterns`.

    `patterns` are rows of PATTERN_SCHEMA and go into the plan as literals, so each regex is compiled once, and no row is
    joined to a vocabulary: a needed literal is looked for first, then the regex, the allowed containers and the denial.
    """
    lower = F.lower(F.col(name))
    return _classes(_tests(patterns, name, container, lambda i, needles: reduce(lambda a, b: a | b, (lower.contains(n) for n in needles))))


def classify(files: DataFrame, patterns: list[tuple], name: str = "name", container: str | None = None) -> DataFrame:
    """(all columns, document_class) for every class a file matches."""
    return files.withColumn("document_class", F.explode(class_list(patterns, name, container)))


def needle_hits(files: DataFrame, patterns: list[tuple], name: str) -> DataFrame:
    """Adds `hits`, the numbers of the patterns of which a needed literal occurs in the lower-case name.

    All literals are one automaton, compiled once and broadcast (its size is the vocabulary's); a name is read once, however many literals there are.
    """
    import ahocorasick

    numbers: dict[str, set[int]] = {}
    for i, (_, _, needles, _, _) in enumerate(patterns):
        for n in needles or []:
            numbers.setdefault(n.lower(), set()).add(i)
    automaton = ahocorasick.Automaton()
    for n, ids in numbers.items():
        automaton.add_word(n, tuple(sorted(ids)))
    automaton.make_automaton()
    shared = files.sparkSession.sparkContext.broadcast(automaton)

    @F.pandas_udf("array<int>")
    def hits(names: pd.Series) -> pd.Series:
        found = shared.value
        return pd.Series([sorted({i for _, ids in found.iter(n) for i in ids}) if n else [] for n in names])

    once = hits.asNondeterministic()  # so that no filter above is pushed below and runs it again
    return files.withColumn("hits", once(F.lower(F.col(name))) if numbers else F.array().cast("array<int>"))


def classify_many(files: DataFrame, patterns: list[tuple], name: str = "name", container: str | None = None) -> DataFrame:
    """Adds `classes`, as `class_list` gives them, for a large vocabulary: one pass of an automaton over each name, and a regex only where it has a hit."""
    found = needle_hits(files, patterns, name)
    return found.withColumn("classes", _classes(_tests(patterns, name, container, lambda i, _: F.array_contains("hits", i)))).drop("hits")


def closed(edges: list[tuple[str, str]]) -> dict[str, list[str]]:
    """Every class with all its ancestors; a constant of the plan, as a vocabulary's edges are few. A class on a cycle is an ancestor of its own."""
    parents: dict[str, set[str]] = {}
    for child, parent in edges:
        parents.setdefault(child, set()).add(parent)
    out = {}
    for child in parents:
        seen, todo = set(), list(parents[child])
        while todo:
            p = todo.pop()
            if p not in seen:
                seen.add(p)
                todo.extend(parents.get(p, ()))
        out[child] = sorted(seen)
    return out


def rolled_up(classes: Column | str, ancestors: dict[str, list[str]]) -> Column:
    """A list of classes with all their ancestors, sorted: literals in the projection, no join and no shuffle."""
    own = F.col(classes) if isinstance(classes, str) else classes
    if not ancestors:
        return F.array_sort(F.array_distinct(own))
    known = F.create_map(*(x for c, above in ancestors.items() for x in (F.lit(c), F.array(*map(F.lit, above)))))
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.concat(own, F.flatten(F.transform(own, lambda c: F.coalesce(F.try_element_at(known, c), none))))))


def closure(edges: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(child, ancestor) pairs of a class graph, each once; cycles end as no new pair appears.

    The vocabulary's edges are few, so a round per level of depth is enough.
    """
    known = edges.select(F.col(child).alias("child"), F.col(parent).alias("ancestor")).distinct()
    step = edges.select(F.col(child).alias("_c"), F.col(parent).alias("_p")).distinct()
    size = known.count()
    while True:
        further = known.join(step, F.col("ancestor") == F.col("_c")).select("child", F.col("_p").alias("ancestor"))
        known = cut(known.union(further).distinct())
        now = known.count()
        if now == size:
            return known
        size = now


def subject_scope(models: Column, makers: Column) -> Column:
    """null / multi_manufacturer / multi_model / single_model from subject counts."""
    return F.when(models.isNull() | (models == 0), F.lit(None)).when(makers > 1, "multi_manufacturer").when(models > 1, "multi_model").otherwise("single_model")


def register_subject_scope(spark: SparkSession) -> None:
    """The same rule as a SQL function of the session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION subject_scope(models BIGINT, makers BIGINT) RETURNS STRING RETURN CASE "
        "WHEN models IS NULL OR models = 0 THEN NULL WHEN makers > 1 THEN 'multi_manufacturer' WHEN models > 1 THEN 'multi_model' ELSE 'single_model' END"
    )


def guarded_distinct(value: Column, member: Column) -> Column:
    """Distinct count of value, null unless every member has one."""
    return F.when(F.count_distinct(F.when(value.isNull(), member)) == 0, F.count_distinct(value))
