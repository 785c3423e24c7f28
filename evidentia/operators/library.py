"""The document library: works, their addresses and subjects, set-based."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.operators.components import connected_components
from evidentia.session import cut, stored


#: Minted ids lie above this; ids given by hand or by a catalog lie below.
MINTED = 1 << 62


def minted_id(url: Column) -> Column:
    """An id that the address alone gives, so that a repeated run mints the same; never negative, never a given one."""
    return F.xxhash64(url).bitwiseAND(F.lit(MINTED - 1)).bitwiseOR(F.lit(MINTED))


def register(urls: DataFrame, owned: DataFrame) -> DataFrame:
    """(url, document_id, minted): the existing owner's id, else one minted from the url; the first title stays with its owner."""
    have = owned.select("url", F.col("document_id").alias("_owner")).distinct()
    return urls.select("url").where("url is not null").distinct().join(have, "url", "left").select("url", F.coalesce("_owner", minted_id(F.col("url"))).alias("document_id"), F.col("_owner").isNull().alias("minted"))


def adopt_redirects(redirects: DataFrame, owners: DataFrame) -> DataFrame:
    """(requested, final, action): an unowned final address joins the requested one's document; two owners conflict."""
    a = owners.select(F.col("url").alias("requested"), F.col("document_id").alias("_a"))
    b = owners.select(F.col("url").alias("final"), F.col("document_id").alias("_b"))
    joined = redirects.join(a, "requested", "left").join(b, "final", "left")
    action = F.when(F.col("_a").isNull(), "none").when(F.col("_b").isNull(), "adopt").when(F.col("_a") == F.col("_b"), "none").otherwise("conflict")
    return joined.select("requested", "final", action.alias("action"), F.col("_a").alias("document_id"))


def merge_map(pairs: DataFrame) -> DataFrame:
    """(loser, survivor) with chains closed: every document of a group goes to its smallest id."""
    return connected_components(pairs, "loser", "survivor").where("node <> component").select(F.col("node").alias("loser"), F.col("component").alias("survivor"))


def merge_documents(documents: DataFrame, pairs: DataFrame, fields: list[str], key: str = "document_id") -> tuple[DataFrame, DataFrame]:
    """Merged documents and the dropped values.

    The survivor's values win, then the smallest loser's; a loser's other value is reported as
    (document_id, loser, field, value) and never overwrites.
    """
    mapped = documents.join(merge_map(pairs).withColumnRenamed("loser", key), key, "left").withColumn("_to", F.coalesce("survivor", key))
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(F.col(key) != F.col("_to"), F.col(key))))
    merged = mapped.groupBy("_to").agg(*(first(c).alias(c) for c in fields), F.count("*").alias("n_merged")).withColumnRenamed("_to", key)
    kept = merged.select(F.col(key).alias("_to"), *(F.col(c).alias(f"_kept_{c}") for c in fields))
    lost = mapped.where(F.col(key) != F.col("_to")).join(kept, "_to")
    parts = F.array(*(F.when(F.col(c) != F.col(f"_kept_{c}"), F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value"))) for c in fields))
    dropped = lost.select(F.col("_to").alias(key), F.col(key).alias("loser"), F.explode(F.filter(parts, lambda p: p.isNotNull())).alias("p")).select(key, "loser", "p.field", "p.value")
    return merged, dropped


def move_children(children: DataFrame, mapping: DataFrame, key: str = "document_id") -> DataFrame:
    """Addresses, classes or subjects of merged documents go to the survivor; what both had is kept once."""
    to = mapping.select(F.col("loser").alias(key), F.col("survivor").alias("_to"))
    moved = children.join(to, key, "left")
    return moved.select(*(F.coalesce("_to", key).alias(c) if c == key else F.col(c) for c in children.columns)).distinct()


#: Distinct combinations of identities up to which a document's subjects are folded in one row.
FOLD = 64


def _folded(tuples: DataFrame) -> DataFrame:
    """(tuples' columns, subject): a document's combinations folded one by one into groups that share a key."""
    none = F.array().cast("array<struct<root: bigint, keys: array<string>>>")

    def take(groups: Column, t: Column) -> Column:
        met = F.filter(groups, lambda g: F.arrays_overlap(g["keys"], t["keys"]))
        root = F.least(t["row_id"], F.array_min(F.transform(met, lambda g: g["root"])))
        keys = F.array_union(t["keys"], F.flatten(F.transform(met, lambda g: g["keys"])))
        return F.concat(F.filter(groups, lambda g: ~F.arrays_overlap(g["keys"], t["keys"])), F.array(F.struct(root.alias("root"), keys.alias("keys"))))

    whole = tuples.groupBy("_d").agg(F.collect_list(F.struct(*(c for c in tuples.columns if c != "_d"))).alias("tuples"))
    whole = whole.withColumn("groups", F.aggregate("tuples", none, take))
    each = whole.select("_d", "groups", F.explode("tuples").alias("t"))
    root = F.get(F.filter("groups", lambda g: F.arrays_overlap(g["keys"], F.col("t.keys"))), F.lit(0))["root"]
    return each.select("_d", "t.*", root.alias("subject"))


def _contracted(tuples: DataFrame) -> DataFrame:
    """The same as `_folded` by connected components, for documents of very many combinations."""
    each = tuples.select("_d", "row_id", F.explode("keys").alias("key"))
    hub = each.groupBy("_d", "key").agg(F.min("row_id").alias("hub"))
    edges = each.join(hub, ["_d", "key"]).where("row_id <> hub").select(F.col("row_id").alias("src"), F.col("hub").alias("dst"))
    groups = connected_components(edges).withColumnRenamed("node", "row_id")
    return tuples.join(groups, "row_id", "left").withColumn("subject", F.coalesce("component", "row_id")).drop("component")


def unify_subjects(subjects: DataFrame, doc: str, identities: list[str], names: list[str], fold: int = FOLD) -> DataFrame:
    """One subject per group of rows of a document that share any identity.

    (doc, subject, <identities>, <names>, n_rows, conflict): identities and names fill nulls; two values of one identity
    are a conflict, reported and not overwritten. `subjects` needs a `row_id`, a whole number; rows of a document that repeat one
    are one subject. Rows without a document or without any identity stand alone. Rows of equal identities are combined before the shuffle; a document's combinations
    are folded in one row up to `fold` of them, and contracted as a graph beyond it, with the same result.
    """
    tag = lambda c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string")))
    again = F.lit(None).cast("string")
    repeats = cut(subjects.where(F.col(doc).isNotNull()).groupBy(doc, "row_id").count().where("count > 1").select(doc, "row_id"))
    if not repeats.isEmpty():
        subjects = subjects.join(repeats.withColumn("_again", F.lit(True)), [doc, "row_id"], "left")
        again = F.when(F.col("_again"), F.concat(F.lit("#row="), F.col("row_id").cast("string")))
    keys = F.array_compact(F.array(*map(tag, identities), again))
    alone = F.when(F.col(doc).isNull() | (F.size(keys) == 0), F.col("row_id"))
    first = [F.min(F.when(F.col(c).isNotNull(), F.struct(F.col("row_id").alias("at"), F.col(c).alias("value")))).alias(f"_n{i}") for i, c in enumerate(names)]
    by = [F.col(c).alias(f"_i{i}") for i, c in enumerate(identities)]
    rows = subjects.groupBy(F.col(doc).alias("_d"), *by, keys.alias("keys"), alone.alias("alone")).agg(F.min("row_id").cast("long").alias("row_id"), F.count("*").alias("n"), *first)
    rows = stored(rows, "subjects")
    single = rows.where("alone is not null").withColumn("subject", F.col("row_id")).drop("alone")
    tuples = rows.where("alone is null").drop("alone")
    large = tuples.groupBy("_d").count().where(F.col("count") > fold).select("_d")
    named = _folded(tuples.join(large, "_d", "left_anti")).unionByName(single)
    if not large.isEmpty():
        named = named.unionByName(_contracted(tuples.join(large, "_d", "left_semi")))
    filled = [F.min(F.when(F.col(f"_i{i}").isNotNull(), F.struct("row_id", f"_i{i}")))[f"_i{i}"].alias(c) for i, c in enumerate(identities)]
    filled += [F.min(f"_n{i}")["value"].alias(c) for i, c in enumerate(names)]
    clash = F.greatest(*(F.count_distinct(f"_i{i}") for i in range(len(identities))), F.lit(0)) > 1
    return named.groupBy(F.col("_d").alias(doc), "subject").agg(*filled, F.sum("n").alias("n_rows"), clash.alias("conflict"))


def class_judgments(held: DataFrame, given: DataFrame, sources: list[str]) -> DataFrame:
    """One judgment per (document_id, document_class): the source earliest in `sources` wins, what is held wins a tie."""
    order = F.array_position(F.array(*map(F.lit, sources)), F.col("source"))
    both = held.withColumn("_new", F.lit(0)).unionByName(given.withColumn("_new", F.lit(1)))
    w = Window.partitionBy("document_id", "document_class").orderBy(order, "_new")
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_new")


def enrich_refs(refs: DataFrame, catalog: DataFrame, on: str, stored: str, resolved: str) -> DataFrame:
    """Adds value and mismatch: the stored value is only filled, never replaced; a differing one is reported."""
    joined = refs.join(catalog, on, "left")
    return joined.withColumn("value", F.coalesce(stored, resolved)).withColumn("mismatch", F.coalesce(F.col(stored) != F.col(resolved), F.lit(False)))


def display_title(title: Column, subject: Column, fallback: Column) -> Column:
    """The subject leads unless the title already holds it."""
    joined = F.when(subject.isNull() | F.lower(title).contains(F.lower(subject)), title).otherwise(F.concat_ws(" – ", subject, title))
    return F.coalesce(joined, subject, fallback)


def metadata_text(parts: list[Column]) -> Column:
    """One searchable string of distinct non-empty parts."""
    return F.array_join(F.array_distinct(F.filter(F.array(*parts), lambda p: p.isNotNull() & (p != ""))), " ")


def class_counts(vocabulary: DataFrame, judged: DataFrame) -> DataFrame:
    """(document_class, n) of every class, those without documents too."""
    return vocabulary.join(judged.select("document_class", "document_id"), "document_class", "left").groupBy("document_class").agg(F.count("document_id").alias("n"))
