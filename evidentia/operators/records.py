"""Smaller set-based operators over pages, documents and search results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.urls import normalize
from evidentia.operators.library import minted_id
from evidentia.operators.navigate import page_blocks, sections


def dashed_id(text: Column) -> Column:
    """`group-machine-alias` to its parts; an empty part is null."""
    part = lambda k: F.nullif(F.split_part(text, F.lit("-"), F.lit(k)), F.lit(""))
    return F.struct(part(1).alias("group_id"), part(2).alias("machine_id"), part(3).alias("alias_id"))


def is_resolvable(category: Column, target: Column, pattern: str, open_category: str) -> Column:
    """Three-valued: null for the category that has no ids yet, else whether the target has the id's form."""
    return F.when(category != open_category, target.rlike(pattern))


def metadata_block(lines: DataFrame, key: str = "url") -> DataFrame:
    """(key, metadata, body): frontmatter lines, and the rest."""
    part = lambda test: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(test, F.struct("line_no", "line")))), lambda s: s["line"]), "\n")
    inner = F.col("in_meta") & ~F.col("line").rlike(r"\A---\s*\z")
    return lines.groupBy(key).agg(part(inner).alias("metadata"), part(~F.col("in_meta")).alias("body"))


def paging_tier(text_pages: DataFrame, ocr_pages: DataFrame, key: str = "url") -> DataFrame:
    """(key, tier): the text tier defines pages if it has more than one, else the OCR tier if that has."""
    a = text_pages.groupBy(key).agg(F.max("page_no").alias("a"))
    b = ocr_pages.groupBy(key).agg(F.max("page_no").alias("b"))
    return a.join(b, key, "full_outer").select(key, F.when(F.col("a") > 1, "text").when(F.col("b") > 1, "ocr").alias("tier"))


def named_blocks(requests: DataFrame, lines: DataFrame, key: str = "url", tier: str = "text") -> DataFrame:
    """(key, heading, tier, kind, line_no, text): every block that answers to each asked (key, heading), whatever its case.

    On a document with pages `page N` is that page, and line_no its number; any other name is a section. All sections of a name come back.
    """
    number = F.regexp_extract(F.lower("heading"), r"\Apage (\d+)\z", 1).try_cast("int")
    pages = page_blocks(lines, key)
    paginated = pages.groupBy(key).agg((F.max("page_no") > 1).alias("_paged"))
    asked = requests.join(paginated, key).withColumn("_n", F.when(F.col("_paged"), number))
    sheets = asked.where("_n is not null").join(pages.withColumnRenamed("page_no", "_n"), [key, "_n"]).select(key, "heading", F.lit("page").alias("kind"), F.col("_n").cast("long").alias("line_no"), "text")
    spans = sections(lines, key).select(F.col(key).alias("_k"), F.lower("heading").alias("_name"), F.col("line_no").alias("_a"), F.col("end_line").alias("_b"))
    met = asked.where("_n is null").join(spans, (F.col(key) == F.col("_k")) & (F.lower("heading") == F.col("_name"))).select(key, "heading", "_a", F.explode(F.sequence("_a", "_b")).alias("line_no"))
    each = met.join(lines.select(key, "line_no", "line"), [key, "line_no"])
    listed = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    own = each.groupBy(key, "heading", "_a").agg(F.array_join(F.transform(listed, lambda x: x["line"]), "\n").alias("text")).select(key, "heading", F.lit("section").alias("kind"), F.col("_a").cast("long").alias("line_no"), "text")
    return sheets.unionByName(own).withColumn("tier", F.lit(tier))


def miss_reason(requests: DataFrame, pages: DataFrame, headings: DataFrame, key: str = "url") -> DataFrame:
    """Why (key, heading) finds nothing: no text, not paginated, out of range, empty sheet, near heading, unknown; null on a hit.

    `page N` asks for a page. `pages` has (key, page_no, text), `headings` (key, heading).
    """
    number = F.regexp_extract(F.lower(F.col("heading")), r"\Apage (\d+)\z", 1).try_cast("int")
    extent = pages.groupBy(F.col(key).alias("_k")).agg(F.max("page_no").alias("last_page"), F.max(F.length("text")).alias("longest"))
    named = headings.groupBy(F.col(key).alias("_h")).agg(F.collect_set(F.lower("heading")).alias("names"))
    sheet = pages.select(F.col(key).alias("_p"), F.col("page_no").alias("_no"), F.col("text").alias("_sheet"))
    rows = requests.withColumn("_n", number).join(extent, F.col(key) == F.col("_k"), "left").join(named, F.col(key) == F.col("_h"), "left")
    rows = rows.join(sheet, (F.col(key) == F.col("_p")) & (F.col("_n") == F.col("_no")), "left")
    wanted, names = F.lower("heading"), F.coalesce("names", F.array().cast("array<string>"))
    reason = (
        F.when(F.coalesce("longest", F.lit(0)) == 0, "no text")
        .when(F.col("_n").isNotNull(), F.when(F.col("last_page") <= 1, "not paginated").when(~F.col("_n").between(1, F.col("last_page")), "out of range").when(F.trim("_sheet") == "", "empty sheet"))
        .when(F.array_contains(names, wanted), F.lit(None))
        .when(F.exists(names, lambda h: h.contains(wanted) | wanted.contains(h)), "near heading")
        .otherwise("unknown")
    )
    return rows.select(key, "heading", reason.alias("reason"))


def captures_for_refs(refs: DataFrame, documents: DataFrame, document_urls: DataFrame, pages: DataFrame, aliases: DataFrame) -> DataFrame:
    """(ref, document_id, url, page_url): a citation's documents, their addresses, and the page held under each, by itself or its alias."""
    rows = refs.join(documents.select("ref", "document_id"), "ref").join(document_urls.select("document_id", "url"), "document_id")
    held = pages.select(F.col("url").alias("_own"))
    led = aliases.select(F.col("alias_url").alias("_alias"), F.col("url").alias("_led"))
    found = rows.join(held, F.col("url") == F.col("_own"), "left").join(led, F.col("url") == F.col("_alias"), "left")
    return found.select("ref", "document_id", "url", F.coalesce("_own", "_led").alias("page_url")).where("page_url is not null")


def acquisition(document_urls: DataFrame, pages: DataFrame, fetches: DataFrame) -> DataFrame:
    """Adds captured, and blocked: not captured and the last fetch was not answered with 200."""
    last = fetches.groupBy("url").agg(F.max_by("http_status", F.struct("fetched_at", "id")).alias("_status"))
    held = pages.select("url", F.lit(True).alias("_held")).distinct()
    rows = document_urls.join(held, "url", "left").join(last, "url", "left")
    captured = F.coalesce("_held", F.lit(False))
    return rows.withColumn("captured", captured).withColumn("blocked", ~captured & F.coalesce(F.col("_status") != 200, F.lit(False))).drop("_held", "_status")


def decorated(hits: DataFrame, owners: DataFrame, classes: DataFrame, subjects: DataFrame) -> DataFrame:
    """Hits by url with their document, its sorted classes and its distinct subject names (label, else machine, else maker)."""
    c = classes.groupBy("document_id").agg(F.array_join(F.array_sort(F.collect_set("document_class")), ",").alias("classes"))
    s = subjects.groupBy("document_id").agg(F.array_join(F.array_sort(F.collect_set(F.coalesce("label", "machine", "maker"))), ",").alias("subjects"))
    return hits.join(owners, "url", "left").join(c, "document_id", "left").join(s, "document_id", "left")


def interleaved(sections: DataFrame, key: str = "url") -> DataFrame:
    """Both tiers' sections by sheet where every name of the document is a page, else tier by tier: adds ord."""
    page = F.regexp_extract("name", r"\Apage (\d+)\z", 1).try_cast("int")
    rows = sections.withColumn("_sheet", page).withColumn("_all", F.min(page.isNotNull().cast("int")).over(Window.partitionBy(key)))
    order = Window.partitionBy(key).orderBy(F.when(F.col("_all") == 1, F.col("_sheet")), "tier", "line_no")
    return rows.withColumn("ord", F.row_number().over(order)).drop("_sheet", "_all")


def resolve_refs(refs: DataFrame, documents: DataFrame, document_urls: DataFrame) -> DataFrame:
    """(ref, document_id) for numbers that are ids and for any owned address."""
    number = refs.withColumn("_id", F.col("ref").try_cast("long")).join(documents.select(F.col("document_id").alias("_id")), "_id").select("ref", F.col("_id").alias("document_id"))
    by_url = refs.withColumn("_u", normalize(F.col("ref"))).join(document_urls.select(F.col("url").alias("_u"), "document_id"), "_u").select("ref", "document_id")
    return number.union(by_url).distinct()


def set_fields(documents: DataFrame, changes: DataFrame, fields: list[str], key: str = "document_id") -> DataFrame:
    """Apply changes with set_<field> flags, so that setting null differs from leaving alone."""
    c = changes.select(F.col(key), *(F.col(f).alias(f"_new_{f}") for f in fields), *(f"set_{f}" for f in fields))
    rows = documents.join(c, key, "left")
    return rows.select(*(F.when(F.col(f"set_{x}"), F.col(f"_new_{x}")).otherwise(F.col(x)).alias(x) if x in fields else F.col(x) for x in documents.columns))


def document_records(documents: DataFrame, urls: DataFrame, classes: DataFrame, hunts: DataFrame) -> DataFrame:
    """Documents with nested urls, classes and hunts."""
    nest = lambda df, name, *cols: df.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias(name))
    out = documents
    for df, name, cols in ((urls, "urls", ["url", "role"]), (classes, "classes", ["document_class", "source"]), (hunts, "hunts", ["hunted_at", "note"])):
        out = out.join(nest(df, name, *cols), "document_id", "left").withColumn(name, F.coalesce(name, F.array()))
    return out


def guarded_ocr_write(pages: DataFrame, results: DataFrame) -> DataFrame:
    """OCR text goes in only where url and content_sha both still match."""
    r = results.select("url", "content_sha", F.col("ocr_text").alias("_ocr"))
    return pages.join(r, ["url", "content_sha"], "left").withColumn("ocr_text", F.coalesce("_ocr", "ocr_text")).drop("_ocr")


def migrated(pages: DataFrame) -> DataFrame:
    """Rows whose text came from OCR move it to ocr_text."""
    old = F.col("text_source") == "ocr"
    return pages.withColumns({"ocr_text": F.when(old, F.col("text")).otherwise(F.col("ocr_text")), "text": F.when(~F.coalesce(old, F.lit(False)), F.col("text")), "text_source": F.when(~F.coalesce(old, F.lit(False)), F.col("text_source"))})


def oldest_captures(captured: DataFrame, prefix: str) -> DataFrame:
    """(url, timestamp, outcome) under a prefix: the oldest capture of each address; a refused lookup is no negative."""
    rows = captured.where(F.col("original").startswith(prefix))
    each = rows.groupBy(normalize(F.col("original")).alias("url")).agg(F.min(F.when(~F.col("refused"), F.col("timestamp"))).alias("timestamp"), F.max("refused").alias("_r"))
    return each.select("url", "timestamp", F.when(F.col("timestamp").isNotNull(), "found").when(F.col("_r"), "refused").otherwise("none").alias("outcome"))


def listing_seed(files: DataFrame) -> DataFrame:
    """One document per file address, with how many addresses share its base name: a hint to merge."""
    base = F.lower(F.regexp_extract("url", r"([^/]+)\z", 1))
    named = files.select("url").distinct().withColumn("basename", base)
    shared = named.groupBy("basename").agg(F.count("*").alias("merge_hint"))
    return named.join(shared, "basename").select("url", minted_id(F.col("url")).alias("document_id"), "basename", "merge_hint")


def outcome_counts(rows: DataFrame, outcome: str = "outcome") -> DataFrame:
    return rows.groupBy(outcome).agg(F.count("*").alias("n"))


def page_records(requests: DataFrame, pages: DataFrame, column: str = "request") -> DataFrame:
    """The whole page under each requested address in any spelling; nulls where none is held."""
    wanted = requests.select(column, normalize(F.col(column)).alias("_u"))
    held = pages.select(F.col("url").alias("_u"), F.struct(*(c for c in pages.columns)).alias("page"))
    return wanted.join(held, "_u", "left").select(column, "page")


def record_hunts(hunts: DataFrame, new: DataFrame) -> DataFrame:
    """(document_id, hunted_at, note): dated negative results, each once; what was noted first stays."""
    both = hunts.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return both.groupBy("document_id", "hunted_at").agg(F.min_by("note", "_new").alias("note"))


def annotate(work: DataFrame, owners: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(url, document_id, document_class, refusal): classes given to the addresses of a work list.

    Unknown addresses are registered; a row without an address or with a class outside the vocabulary is refused alone.
    """
    url = normalize(F.col("url"))
    rows = work.select(url.alias("url"), "document_class").join(owners.select("url", F.col("document_id").alias("_owner")), "url", "left")
    refusal = F.when(F.col("url").isNull(), "no address").when(~F.col("document_class").isin(vocabulary), "unknown class")
    owner = F.coalesce("_owner", minted_id(F.col("url")))
    return rows.select("url", F.when(refusal.isNull(), owner).alias("document_id"), "document_class", refusal.alias("refusal"))


def hit_labels(lines: DataFrame, hits: DataFrame, key: str = "url") -> DataFrame:
    """Hits (key, first_line, last_line) with the section they lie in, null if they cross sections, and the pages they touch."""
    inside = hits.join(lines.select(F.col(key).alias("_k"), "line_no", "line", "section", "section_start", "page_no"), (F.col(key) == F.col("_k")) & F.col("line_no").between(F.col("first_line"), F.col("last_line")))
    shown = inside.where((F.trim("line") != "") & (F.col("line") != "\f"))
    one = F.min(F.coalesce("section_start", F.lit(-1))) == F.max(F.coalesce("section_start", F.lit(-1)))
    found = shown.groupBy(key, "first_line", "last_line").agg(one.alias("_one"), F.min("section").alias("_s"), F.array_sort(F.collect_set("page_no")).alias("pages"))
    return found.select(key, "first_line", "last_line", F.when(F.col("_one"), F.col("_s")).alias("section"), "pages")
