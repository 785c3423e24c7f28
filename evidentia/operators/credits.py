"""Credits of a model: roles by the vocabulary, who may supply them, and spellings that hold for a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions import parse
from evidentia.functions import vocabulary as voc

#: Spellings that may be broadcast.
MOST_SPELLINGS = 100_000


def credits(models: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """(key, role, role_slug, person) of real people.

    The dump's role fields of comma-separated names count. A role for which the vocabulary names no field comes from archived pages (key,
    credits: array<struct<role, name>>) by its labels, until the vocabulary gives it one; a page's credits for other roles never override the dump.
    """
    fields = [(role, slug, field) for role, slug, field, _ in voc.CREDIT_ROLES if field]
    stacked = models.select(key, F.inline(F.array(*(F.struct(F.lit(role).alias("role"), F.lit(slug).alias("role_slug"), F.col(field).alias("names")) for role, slug, field in fields))))
    dumped = stacked.where("names <> ''").select(key, "role", "role_slug", F.explode(parse.people(F.col("names"))).alias("person"))
    labels = {label: (role, slug) for role, slug, field, known in voc.CREDIT_ROLES if not field for label in known}
    stated = pages.select(key, F.explode("credits").alias("c"))
    role = F.coalesce(*(F.when(F.col("c.role") == label, F.struct(F.lit(r).alias("role"), F.lit(s).alias("role_slug"))) for label, (r, s) in labels.items()))
    archived = stated.withColumn("r", role).where("r is not null").select(key, "r.role", "r.role_slug", F.trim("c.name").alias("person"))
    return dumped.unionByName(archived).where(parse.is_person(F.col("person")))


def as_of(rows: DataFrame, spellings: DataFrame, name: str, day: str) -> DataFrame:
    """Each row with the columns of the spelling that holds on its day: from `since` on and before `until`, which may be null; null where none does.

    Of spellings that overlap the one that starts last counts while it holds. The vocabulary is a few rows, whose count is checked,
    so it is broadcast and no row is shuffled, however common a spelling is.
    """
    if spellings.count() > MOST_SPELLINGS:
        raise ValueError(f"a vocabulary of more than {MOST_SPELLINGS} spellings is not broadcast")
    others = [c for c in spellings.columns if c not in (name, "since", "until")]
    following = F.lead("since").over(Window.partitionBy(name).orderBy("since", F.col("until").asc_nulls_last()))
    spans = spellings.withColumn("_until", F.least("until", following)).select(F.col(name).alias("_name"), F.col("since").alias("_since"), "_until", *others)  # least passes over nulls
    holds = (F.col(name) == F.col("_name")) & (F.col("_since") <= F.col(day)) & (F.col("_until").isNull() | (F.col(day) < F.col("_until")))
    return rows.join(F.broadcast(spans), holds, "left").drop("_name", "_since", "_until")
