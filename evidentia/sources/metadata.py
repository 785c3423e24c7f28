"""Metadata beside the text: a page's head as frontmatter, what a carrier says over what was extracted, and extraction done anew."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Keys of head metadata that are kept, most general first; of equal values the first key's stays.
META_KEYS = [
    "description", "og:description", "twitter:description", "keywords", "news_keywords", "author", "og:title", "twitter:title", "og:site_name",
    "article:published_time", "article:modified_time", "article:tag", "article:section", "article:author",
]


def _collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def head_metadata(tags: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, title_tag, og_title, lines) from a tag stream: `key: value` lines of the title and the kept keys, each value once.

    Values are compared after white space is collapsed, and case tells them apart. A page without any has no row.
    """
    rank = F.when(F.col("tag") == "title", 0).when(F.col("tag") == "meta", F.nullif(F.array_position(F.array(*map(F.lit, META_KEYS)), F.lower(F.trim("name"))), F.lit(0)))
    value = _collapsed(F.when(F.col("tag") == "title", F.col("text")).otherwise(F.col("content")))
    found = tags.where(F.col("tag").isin("title", "meta")).select(key, "seq", rank.alias("rank"), value.alias("value")).where("rank is not null and value <> ''")
    first_title = F.row_number().over(Window.partitionBy(key, "rank").orderBy("seq"))
    found = found.withColumn("n", first_title).where("rank > 0 or n = 1")
    once = found.withColumn("again", F.row_number().over(Window.partitionBy(key, "value").orderBy("rank", "seq")))
    named = F.concat_ws(": ", F.element_at(F.array(*map(F.lit, ["title", *META_KEYS])), (F.col("rank") + 1).cast("int")), "value")
    lines = F.transform(F.array_sort(F.collect_list(F.when(F.col("again") == 1, F.struct("rank", "seq", named.alias("line"))))), lambda x: x["line"])
    og = META_KEYS.index("og:title") + 1
    return once.groupBy(key).agg(
        F.max(F.when(F.col("rank") == 0, F.col("value"))).alias("title_tag"), F.min_by("value", F.when(F.col("rank") == og, F.col("seq"))).alias("og_title"), lines.alias("lines")
    )


def frontmatter(lines: Column, body: Column) -> Column:
    """A text with its metadata lines between rules before it; without lines the body alone, without either null."""
    head = F.when(F.size(lines) > 0, F.concat(F.lit("---\n"), F.array_join(lines, "\n"), F.lit("\n---")))
    return F.nullif(F.concat_ws("\n\n", head, F.nullif(body, F.lit(""))), F.lit(""))


def overlay(extracted: DataFrame, carrier: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """All columns of `extracted`, with each of `fields` as its carrier states it or else as extracted, and <field>_source saying which; null where neither does.

    `carrier` has one row per key (key, fields); of repeated ones the least counts.
    """
    stated = carrier.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*fields)).alias("_c"))
    joined = extracted.join(stated, F.col(key) == F.col("_key"), "left")
    merged = {f: F.coalesce(F.col(f"_c.{f}"), F.col(f)) for f in fields}
    sources = {f"{f}_source": F.when(F.col(f"_c.{f}").isNotNull(), "carrier").when(F.col(f).isNotNull(), "extracted") for f in fields}
    kept = [merged[c].alias(c) if c in merged else F.col(c) for c in extracted.columns]
    return joined.select(*kept, *(c.alias(n) for n, c in sources.items()))


def carrier_outcomes(requests: DataFrame, carrier: DataFrame, held: DataFrame, key: str = "url") -> DataFrame:
    """(key, outcome, http_status) of carriers asked for: `failed` and `no track` are rows of the audit log alone, the others store a page.

    `carrier` (key, track_sha) has a row for each that answered, `held` (key, content_sha) the stored pages. `new`, `changed` and `unchanged` compare the
    track with what is held.
    """
    c = carrier.select(F.col(key).alias("_c"), "track_sha")
    h = held.select(F.col(key).alias("_h"), "content_sha")
    joined = requests.join(c, F.col(key) == F.col("_c"), "left").join(h, F.col(key) == F.col("_h"), "left")
    outcome = (
        F.when(F.col("_c").isNull(), "failed").when(F.col("track_sha").isNull(), "no track").when(F.col("_h").isNull(), "new")
        .when(F.col("content_sha").eqNullSafe(F.col("track_sha")), "unchanged").otherwise("changed")
    )
    return joined.select(key, outcome.alias("outcome"), F.when(F.col("_c").isNotNull(), 200).alias("http_status"))


def reextract(pages: DataFrame, blobs: DataFrame, extract: Callable[[DataFrame], DataFrame], version: str, key: str = "url") -> DataFrame:
    """Pages (key, content_sha, text_source, extractor, text) extracted anew where their bytes were last read by another extractor; adds outcome.

    Outcomes, the first that holds: `manual` and `current` are left alone; `missing blob`; `undecodable` (blob null or holding no text); `empty`, where
    the extractor finds nothing and the old text stays; `unchanged`; `rewritten`. `extract` turns (content_sha, content) into (content_sha, text);
    it sees each content that is due once, however many pages share it, and nothing else. Pages that are read, with whatever result,
    get `version`, so a second run touches none of them.
    """
    due = (F.col("text_source") != "manual") & ~F.col("extractor").eqNullSafe(F.lit(version))
    wanted = pages.where(due & F.col("content_sha").isNotNull()).select("content_sha").distinct()
    stored = blobs.join(wanted, "content_sha").dropDuplicates(["content_sha"])
    readable = F.col("content").isNotNull() & ~F.col("content").contains("\x00")
    fresh = extract(stored.where(readable).select("content_sha", "content")).select("content_sha", F.col("text").alias("_new"))
    known = stored.select("content_sha", readable.alias("_readable")).join(fresh, "content_sha", "left")
    joined = pages.join(known, "content_sha", "left")
    blank = F.trim(F.coalesce("_new", F.lit(""))) == ""
    outcome = (
        F.when(F.col("text_source") == "manual", "manual").when(F.col("extractor").eqNullSafe(F.lit(version)), "current").when(F.col("_readable").isNull(), "missing blob")
        .when(~F.col("_readable"), "undecodable").when(blank, "empty").when(F.col("_new").eqNullSafe(F.col("text")), "unchanged").otherwise("rewritten")
    )
    done = joined.withColumn("outcome", outcome)
    rewritten, read = F.col("outcome") == "rewritten", F.col("outcome").isin("rewritten", "unchanged", "empty", "undecodable")
    changed = {"text": F.when(rewritten, F.col("_new")).otherwise(F.col("text")), "extractor": F.when(read, version).otherwise(F.col("extractor"))}
    return done.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in pages.columns), "outcome")
