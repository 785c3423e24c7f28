"""Documents as a table of lines: sections, pages, outlines and verbatim quotes.

Every operator works on the whole table at once; matching ignores case and white space, but what is returned is
always stored text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.text import match_form, sentences


def lines_table(docs: DataFrame, key: str = "url", text: str = "text", frontmatter: bool = False) -> DataFrame:
    """(key, line_no, line, in_meta, heading, level, section, section_start, page_no).

    Headings are ATX lines outside fences and frontmatter; section is the nearest heading at or above, `metadata` inside
    frontmatter, null above the first heading. A form-feed line opens the next page; one at the end opens none.
    """
    raw = docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    w = Window.partitionBy(key).orderBy("line_no")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(key)
    rule = F.col("line").rlike(r"\A---\s*\z")
    if frontmatter:
        opened = F.max(F.when(F.col("line_no") == 0, rule)).over(whole)
        close = F.min(F.when((F.col("line_no") > 0) & rule, F.col("line_no"))).over(whole)
        raw = raw.withColumn("in_meta", F.coalesce(opened & (F.col("line_no") <= close), F.lit(False)))
    else:
        raw = raw.withColumn("in_meta", F.lit(False))
    fence = F.col("line").rlike(r"\A\s{0,3}(?:```|~~~)") & ~F.col("in_meta")
    fences = F.sum(fence.cast("int")).over(so_far)
    raw = raw.withColumn("fenced", (fences % 2 == 1) | fence)
    is_heading = F.col("line").rlike(r"\A#{1,6}\s+\S") & ~F.col("fenced") & ~F.col("in_meta")
    raw = raw.withColumn("heading", F.when(is_heading, F.trim(F.regexp_replace(F.regexp_replace("line", r"\A#{1,6}\s+", ""), r"\s+#*\s*\z", ""))))
    raw = raw.withColumn("level", F.when(is_heading, F.length(F.regexp_extract("line", r"\A(#{1,6})", 1))))
    section = F.when(F.col("in_meta"), "metadata").otherwise(F.last("heading", True).over(so_far))
    start = F.when(F.col("in_meta"), 0).otherwise(F.last(F.when(F.col("heading").isNotNull(), F.col("line_no")), True).over(so_far))
    last_line = F.max(F.when(F.col("line") != "", F.col("line_no"))).over(whole)
    feed = (F.col("line") == "\f") & (F.col("line_no") < last_line)
    return raw.select(
        key, "line_no", "line", "in_meta", "heading", "level", section.alias("section"), start.alias("section_start"),
        (1 + F.sum(feed.cast("int")).over(so_far)).alias("page_no"),
    )


def page_blocks(lines: DataFrame, key: str = "url") -> DataFrame:
    """(key, page_no, text): an empty page exists and has empty text."""
    own = lines.select(key, "page_no", "line_no", F.when(F.col("line") != "\f", F.col("line")).alias("line"))
    pages = own.groupBy(key, "page_no").agg(F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("line_no", "line")))).alias("x"))
    return pages.select(key, "page_no", F.trim(F.array_join(F.transform("x", lambda s: s["line"]), "\n")).alias("text"))


def sections(lines: DataFrame, key: str = "url") -> DataFrame:
    """(key, heading, level, line_no, end_line, chars): a section ends before the next heading of its level or above."""
    heads = lines.where("heading is not null").select(key, "line_no", "heading", "level")
    # read from the end, the nearest later heading of each level or above is a running value
    ahead = Window.partitionBy(key).orderBy(F.desc("line_no")).rowsBetween(Window.unboundedPreceding, -1)
    later = heads.select("*", *(F.last(F.when(F.col("level") <= n, F.col("line_no")), True).over(ahead).alias(f"after{n}") for n in range(1, 7)))
    end = F.coalesce(*(F.when(F.col("level") == n, F.col(f"after{n}")) for n in range(1, 7)))
    bounded = later.select(key, "heading", "level", "line_no", end.alias("stop"))
    ends = lines.groupBy(key).agg(F.max("line_no").alias("last_line"))
    spans = bounded.join(ends, key).select(key, "heading", "level", "line_no", F.coalesce(F.col("stop") - 1, F.col("last_line")).alias("end_line"))
    running = lines.select(key, F.col("line_no").alias("at"), F.sum(F.length("line") + 1).over(Window.partitionBy(key).orderBy("line_no")).alias("upto"), F.length("line").alias("own"))
    first = running.select(F.col(key).alias("k1"), F.col("at").alias("a1"), (F.col("upto") - F.col("own") - 1).alias("before"))
    last = running.select(F.col(key).alias("k2"), F.col("at").alias("a2"), (F.col("upto") - 1).alias("through"))
    sized = spans.join(first, (F.col(key) == F.col("k1")) & (F.col("line_no") == F.col("a1"))).join(last, (F.col(key) == F.col("k2")) & (F.col("end_line") == F.col("a2")))
    return sized.select(key, "heading", "level", "line_no", "end_line", (F.col("through") - F.col("before")).alias("chars"))


def heading_paths(found: DataFrame, key: str = "url") -> DataFrame:
    """Adds `path`, the headings above each heading, outermost first, joined by ` > `.

    The heading above on a level is the last one of that level, unless one of a higher level came after it; six running values say so for
    every heading in one pass.
    """
    before = Window.partitionBy(key).orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    last = [F.last(F.when(F.col("level") == n, F.struct("line_no", "heading")), True).over(before) for n in range(1, 7)]
    rows = found.withColumn("above", F.array(*last))
    line = lambda n: F.coalesce(F.get("above", F.lit(n))["line_no"], F.lit(-1))
    open_ = lambda n: (F.lit(n + 1) < F.col("level")) & (line(n) >= 0) & ((line(n) > F.greatest(*(line(m) for m in range(n)), F.lit(-1))) if n else F.lit(True))
    names = F.array(*(F.when(open_(n), F.get("above", F.lit(n))["heading"]) for n in range(6)))
    return rows.withColumn("path", F.array_join(F.filter(names, lambda x: x.isNotNull()), " > ")).drop("above")


def outline(found: DataFrame, key: str = "url", min_chars: int = 0) -> DataFrame:
    """Headings with their ancestor path; repeats on one path that open no subsection collapse to one with a count."""
    rows = heading_paths(found, key).withColumn("leaf", F.coalesce(F.lead("level").over(Window.partitionBy(key).orderBy("line_no")) <= F.col("level"), F.lit(True)))
    group = F.when(F.col("leaf"), F.lit(-1)).otherwise(F.col("line_no"))
    grouped = rows.withColumn("g", group).groupBy(key, "path", "heading", "level", "g").agg(F.min("line_no").alias("line_no"), F.sum("chars").alias("chars"), F.count("*").alias("n"))
    return grouped.where(F.col("chars") >= min_chars).drop("g")


def paged_outline(lines: DataFrame, key: str = "url", min_chars: int = 0) -> DataFrame:
    """The outline with the page each entry opens on, and on every row how many entries of its document `min_chars` withholds.

    A document all of whose entries are withheld has one row, without a heading.
    """
    rows = outline(sections(lines, key), key).join(lines.select(key, "line_no", "page_no"), [key, "line_no"])
    small = F.col("chars") < min_chars
    counts = rows.groupBy(key).agg(F.count_if(small).alias("withheld"))
    return counts.join(rows.where(~small), key, "left").select(key, "path", "heading", "level", "line_no", "page_no", "chars", "n", "withheld")


def quote_sentences(docs: DataFrame, needle: str, key: str = "url", text: str = "text") -> DataFrame:
    """(key, sentence_no, sentence) of sentences that hold the needle, case and white space apart."""
    pieces = docs.select(key, F.posexplode(sentences(F.col(text))).alias("sentence_no", "sentence"))
    return pieces.where(match_form(F.col("sentence")).contains(match_form(F.lit(needle))))


def needle_lines(lines: DataFrame, needle: str, key: str = "url") -> DataFrame:
    """(key, first_line, last_line) of every occurrence, also across line ends; left to right, none overlapping.

    A document's lines are joined in match form with their offsets; splitting on the needle gives the occurrences, and their
    offsets lead back to lines. The work is linear in lines and occurrences.
    """
    form = F.trim(match_form(F.col("line")))
    wanted = match_form(F.lit(needle))
    kept = lines.select(key, "line_no", form.alias("form")).where("form <> ''")
    before = F.sum(F.length("form") + 1).over(Window.partitionBy(key).orderBy("line_no"))
    placed = kept.withColumn("start", before - F.length("form") - 1)
    joined = placed.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("start", "form"))).alias("x"))
    whole = F.array_join(F.transform("x", lambda s: s["form"]), " ")
    size = F.length(wanted)
    parts = joined.where(whole.contains(wanted)).select(key, F.posexplode(F.split(whole, F.concat(F.lit("\\Q"), wanted, F.lit("\\E")))).alias("k", "part"))
    last = F.max("k").over(Window.partitionBy(key))
    ends = parts.withColumn("after", F.sum(F.length("part") + size).over(Window.partitionBy(key).orderBy("k"))).withColumn("last", last).where("k < last")
    # occurrences and line starts are two sorted lists of a document, merged by one window
    points = ends.select(key, F.explode(F.array(F.struct((F.col("after") - size).alias("at"), F.lit(0).alias("side")), F.struct((F.col("after") - 1).alias("at"), F.lit(1).alias("side")))).alias("p"), "k")
    none = F.lit(None).cast("int")
    union = placed.select(key, F.col("start").alias("at"), none.alias("side"), none.alias("k"), "line_no").unionByName(points.select(key, "p.at", "p.side", "k", none.alias("line_no")))
    so_far = Window.partitionBy(key).orderBy("at", F.col("side").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = union.withColumn("line", F.last("line_no", True).over(so_far)).where("side is not null")
    return found.groupBy(key, "k").agg(F.max(F.when(F.col("side") == 0, F.col("line"))).alias("first_line"), F.max(F.when(F.col("side") == 1, F.col("line"))).alias("last_line")).drop("k")


def quote_windows(lines: DataFrame, needle: str, context: int, key: str = "url") -> DataFrame:
    """Occurrences widened by `context` lines, clipped to their section; overlapping windows of one section merge.

    (key, section_start, first_line, last_line, matches).
    """
    hits = needle_lines(lines, needle, key)
    place = lines.select(key, F.col("line_no").alias("first_line"), F.coalesce("section_start", F.lit(-1)).alias("section_start"))
    bounds = lines.withColumn("s", F.coalesce("section_start", F.lit(-1))).groupBy(key, F.col("s").alias("section_start")).agg(F.min("line_no").alias("low"), F.max("line_no").alias("high"))
    wide = hits.join(place, [key, "first_line"]).join(bounds, [key, "section_start"]).select(
        key, "section_start", F.greatest(F.col("first_line") - context, "low").alias("a"), F.greatest(F.least(F.col("last_line") + context, "high"), "last_line").alias("b")
    )
    w = Window.partitionBy(key, "section_start").orderBy("a", "b")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = wide.withColumn("fresh", F.coalesce((F.col("a") > reach).cast("int"), F.lit(1)))
    ties = Window.partitionBy(key, "section_start").orderBy("a", "b", F.desc("fresh"))
    island = island.withColumn("island", F.sum("fresh").over(ties.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(key, "section_start", "island").agg(F.min("a").alias("first_line"), F.max("b").alias("last_line"), F.count("*").alias("matches")).drop("island")


def transcript(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Caption text to (key, line_no, line): header and note blocks, timings and tags go, consecutive repeats collapse."""
    raw = docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "raw"))
    order = Window.partitionBy(key).orderBy("line_no")
    block = F.sum((F.trim("raw") == "").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    opens = F.col("raw").rlike(r"\A\s*(?:WEBVTT|NOTE|STYLE|REGION)(?![A-Za-z])")
    marked = raw.withColumn("block", block).withColumn("opens", opens)
    skipped = F.max("opens").over(Window.partitionBy(key, "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0))
    clean = F.trim(F.regexp_replace("raw", r"<[^>]*>", ""))
    kept = marked.withColumn("skipped", skipped).where(~F.col("skipped") & ~F.col("raw").contains("-->")).select(key, "line_no", clean.alias("line")).where("line <> ''")
    return kept.withColumn("last", F.lag("line").over(order)).where("last is null or last <> line").drop("last")
