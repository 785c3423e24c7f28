"""Positional postings, phrase match and BM25 over several text spaces.

Postings are hashed by term; a very common term is one key, so its rows are combined per document before the shuffle,
and statistics are aggregates. Top-k comes last, as an ordered limit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.functions.text import tokens
from evidentia.session import cut, stored

#: Fixed values of the ranking function: saturation, length normalisation, and the least inverse document frequency.
K1, B, LEAST_IDF = 1.2, 0.75, 1e-6


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf, positions) per document and term."""
    words = docs.select(key, F.posexplode(tokens(F.coalesce(F.col(text), F.lit("")))).alias("pos", "term"))
    return words.groupBy(key, "term").agg(F.count("*").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))


def _starts(phrase: list[str]):
    """A test of whether the phrase starts at a token; null beyond the end, which a filter drops."""

    def test(token, i):
        return reduce(lambda a, b: a & b, ((token if j == 0 else F.get("tokens", i + j)) == w for j, w in enumerate(phrase)))

    return test


def tokenised(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, tokens). The generator keeps Spark from tokenising anew wherever the tokens are used."""
    return docs.select(key, F.explode(F.array(tokens(F.coalesce(F.col(text), F.lit(""))))).alias("tokens"))


def phrase_hits(docs: DataFrame, phrases: list[list[str]], key: str, text: str) -> DataFrame:
    """(key, length, tf0, tf1, ...): how often each phrase of folded tokens occurs in each document.

    Terms are few and known, so they are tested in one scan without an index; every text is tokenised once.
    """
    counts = [F.size(F.filter("tokens", _starts(phrase))).alias(f"tf{k}") for k, phrase in enumerate(phrases)]
    return tokenised(docs, key, text).select(key, F.size("tokens").alias("length"), *counts)


def postings_phrase(index: DataFrame, phrase: list[str], key: str) -> DataFrame:
    """(key, n) from postings: documents where the phrase's terms stand at consecutive positions.

    Each term is one filter on the index, which a table partitioned or sorted by term answers without the rest.
    """
    met = None
    for j, term in enumerate(phrase):
        one = index.where(F.col("term") == term).select(key, F.transform("positions", lambda p: p - j).alias(f"p{j}"))
        met = one if met is None else met.join(one, key).select(key, F.array_intersect("p0", f"p{j}").alias("p0"))
    return met.select(key, F.size("p0").cast("long").alias("n")).where("n > 0")


def match_regions(docs: DataFrame, phrases: list[list[str]], key: str, text: str) -> DataFrame:
    """(key, regions): marked regions of any phrase, overlapping ones merged to one; documents without a match are left out."""
    toks = tokenised(docs, key, text)

    def found(phrase: list[str]) -> Column:
        at = F.transform("tokens", lambda t, i: F.when(_starts(phrase)(t, i), F.struct(i.alias("a"), (i + len(phrase)).alias("b"))))
        return F.filter(at, lambda x: x.isNotNull())

    spans = [found(phrase) for phrase in phrases]
    marked = toks.select(key, F.array_sort(F.concat(*spans)).alias("spans")).where(F.size("spans") > 0)
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).alias("n"))
    folded = F.aggregate("spans", start, lambda s, x: F.struct(F.greatest(s["end"], x["b"]).alias("end"), (s["n"] + (x["a"] >= s["end"]).cast("int")).alias("n")))
    return marked.select(key, folded["n"].cast("long").alias("regions"))


def snippet(docs: DataFrame, terms: list[str], key: str, text: str, width: int = 12) -> DataFrame:
    """(key, snippet): the first window of `width` tokens with most matched tokens, these in brackets, what is left out as an ellipsis."""
    toks = tokenised(docs, key, text)
    marked = toks.select(key, F.transform("tokens", lambda t: F.when(t.isin(terms), F.concat(F.lit("["), t, F.lit("]"))).otherwise(t)).alias("shown"), F.transform("tokens", lambda t: t.isin(terms).cast("int")).alias("hits"))
    running = marked.where(F.array_contains("hits", 1))
    last = F.greatest(F.size("shown") - width, F.lit(0))
    held = lambda i: F.aggregate(F.slice("hits", i + 1, F.lit(width)), F.lit(0), lambda n, h: n + h)
    best = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(held(i).alias("n"), (-i).alias("i")))
    chosen = running.withColumn("at", -F.array_max(best)["i"])
    body = F.array_join(F.slice("shown", F.col("at") + 1, F.lit(width)), " ")
    return chosen.select(key, F.concat(F.when(F.col("at") > 0, "… ").otherwise(""), body, F.when(F.col("at") + width < F.size("shown"), " …").otherwise("")).alias("snippet"))


def line_hits(lines: DataFrame, phrase: list[str], key: str, *columns: str) -> DataFrame:
    """(key, line_no, columns, n, starts) of lines with tokens: how many, and the places in the line where the phrase starts.

    A match may run on over line ends. Only the tokens at both ends of a line go through the window over lines, so no task sorts a text's tokens.
    """
    m = len(phrase)
    none = F.array().cast("array<string>")
    cut_up = lines.select(key, "line_no", *columns, F.explode(F.array(tokens(F.col("line")))).alias("tokens")).where(F.size("tokens") > 0)

    def found(words: str) -> Column:
        test = lambda t, i: reduce(lambda a, b: a & b, ((t if j == 0 else F.get(words, i + j)) == w for j, w in enumerate(phrase)))
        return F.filter(F.transform(words, lambda t, i: F.when(test(t, i), i)), lambda i: i.isNotNull())

    n = F.size("tokens")
    rows = cut_up.select(
        key, "line_no", *columns, n.alias("n"), found("tokens").alias("starts"),
        (F.slice("tokens", 1, m - 1) if m > 1 else none).alias("head"), (F.slice("tokens", F.greatest(n - m + 2, F.lit(1)), F.lit(m - 1)) if m > 1 else none).alias("tail"),
    )
    if m > 1:  # a line has a token at least, so the rest of a match is in the next m - 1 of them
        order = Window.partitionBy(key).orderBy("line_no")
        rows = rows.withColumn("over", F.concat("tail", *(F.coalesce(F.lead("head", j).over(order), none) for j in range(1, m))))
        beyond = F.filter(found("over"), lambda i: i < F.size("tail"))
        rows = rows.withColumn("starts", F.concat("starts", F.transform(beyond, lambda i: i + F.col("n") - F.size("tail"))))
    return rows.select(key, "line_no", *columns, "n", "starts")


def matched_regions(lines: DataFrame, phrase: list[str], key: str, regions: list[str]) -> DataFrame:
    """(key, regions, matches): where a phrase occurs, by the region that each match starts in; a match may run over line ends."""
    each = line_hits(lines, phrase, key, *regions).where(F.size("starts") > 0)
    return each.groupBy(key, *regions).agg(F.sum(F.size("starts").cast("long")).alias("matches"))


def bm25(docs: DataFrame, phrases: list[list[str]], key: str, text: str) -> DataFrame:
    """(key, score) of documents that hold every phrase; a higher score is better.

    idf = ln((N - n + 0.5) / (n + 0.5)), at least LEAST_IDF; lengths and N are those of the whole space.
    """
    hits = cut(phrase_hits(docs, phrases, key, text))  # counts alone, so that the statistics don't tokenise anew
    n = len(phrases)
    stats = hits.agg(F.count("*").alias("n_docs"), F.avg("length").alias("avg_length"), *(F.count_if(F.col(f"tf{k}") > 0).alias(f"df{k}") for k in range(n)))
    every = reduce(lambda a, b: a & b, ((F.col(f"tf{k}") > 0) for k in range(n)))
    parts = []
    for k in range(n):
        idf = F.greatest(F.ln((F.col("n_docs") - F.col(f"df{k}") + 0.5) / (F.col(f"df{k}") + 0.5)), F.lit(LEAST_IDF))
        tf = F.col(f"tf{k}")
        parts.append(F.when(F.col("n_docs") - F.col(f"df{k}") + 0.5 > 0, idf) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.col("avg_length"))))
    return hits.where(every).crossJoin(F.broadcast(stats)).select(key, reduce(lambda a, b: a + b, parts).alias("score"))


def two_tier(first: DataFrame, second: DataFrame, key: str, limit: int, names: tuple[str, str] = ("text", "ocr")) -> DataFrame:
    """One row per document from two rankings: both scores, the better one leads, ties by key; then the limit."""
    a = first.select(key, F.col("score").alias(f"{names[0]}_score"))
    b = second.select(key, F.col("score").alias(f"{names[1]}_score"))
    merged = a.join(b, key, "full_outer").withColumn("score", F.greatest(f"{names[0]}_score", f"{names[1]}_score"))
    merged = merged.withColumn("tier", F.when(F.coalesce(F.col(f"{names[0]}_score") >= F.col("score"), F.lit(False)), names[0]).otherwise(names[1]))
    return merged.orderBy(F.desc("score"), key).limit(limit) if limit > 0 else merged


def grouped_hits(hits: DataFrame, owner: str, key: str, limit: int) -> DataFrame:
    """One slot per owning document, best first, its other hits attached; the limit counts documents."""
    best = hits.groupBy(owner).agg(F.max("score").alias("best"))
    top = best.orderBy(F.desc("best"), owner).limit(limit)
    ranked = top.withColumn("doc_rank", F.row_number().over(Window.orderBy(F.desc("best"), owner)))  # after the limit: a few rows
    inside = Window.partitionBy(owner).orderBy(F.desc("score"), key)
    return hits.join(F.broadcast(ranked.select(owner, "doc_rank")), owner).withColumn("hit_rank", F.row_number().over(inside))


def match_windows(lines: DataFrame, phrase: list[str], words: int, key: str = "url") -> DataFrame:
    """Matches of one phrase with about `words` words around, in whole lines of one section, overlapping ones merged.

    (key, section_start, first_line, last_line, matches); a match belongs to the region it starts in.
    """
    order = Window.partitionBy(key).orderBy("line_no")
    each = line_hits(lines.withColumn("section_start", F.coalesce("section_start", F.lit(-1))), phrase, key, "section_start")
    counted = stored(each.withColumn("stop", F.sum(F.col("n").cast("long")).over(order)).withColumn("start", F.col("stop") - F.col("n")), "window-lines")  # without the text
    hits = counted.select(key, "section_start", F.col("line_no").alias("hit_line"), "start", F.explode("starts").alias("p")).withColumn("at", F.col("start") + F.col("p"))
    hits = hits.select(key, "section_start", (F.col("at") - words // 2).alias("from"), (F.col("at") + len(phrase) - 1 + words // 2).alias("to"), "hit_line")
    spans = counted.select(F.col(key).alias("k"), F.col("section_start").alias("s"), "line_no", "start", F.col("stop").alias("end"))
    near = hits.join(spans, (F.col(key) == F.col("k")) & (F.col("section_start") == F.col("s")) & (F.col("start") <= F.col("to")) & (F.col("end") > F.col("from")))
    wide = near.groupBy(key, "section_start", "from", "to", "hit_line").agg(F.min("line_no").alias("a"), F.max("line_no").alias("b"))
    w = Window.partitionBy(key, "section_start").orderBy("a", "b", "from")
    reach = F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = wide.withColumn("fresh", F.coalesce((F.col("a") > reach).cast("int"), F.lit(1)))
    marked = marked.withColumn("island", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(key, "section_start", "island").agg(F.min("a").alias("first_line"), F.max("b").alias("last_line"), F.count("*").alias("matches")).drop("island")
