"""Operator 1: fuzzy line dedup by sketches of word pairs, blocks that cross a line's halves and edit similarity, in DataFrame functions alone.

SimHash is not used: on the near lines of the documents its bits differ too much for any block wide enough that unlike
lines rarely share it (README has the figures). The sketch here keeps the pairs of words with the least hashes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.operators.components import connected_components
from evidentia.session import cut, stored

#: Least edit similarity, 1 - distance / longer length, of linked lines.
SIMILARITY = 0.8
#: Elements of the sketch of each half of a line. Lines that share one of the first half and one of the second meet.
SKETCH = 3
#: Hashes among which repeats are looked for.
REPEATS = 12
#: Bytes of a pair of words from which it is sketched before shorter pairs, which many unlike lines share.
TELLING = 9
#: Words up to which a line also meets lines that differ in one word, and up to which it is sketched by groups of GROUP letters.
SHORT, FEW, GROUP = 8, 4, 6
#: Sketch of letter groups: lines that share three of their first six meet.
LETTERED = (6, 3)
#: Letters up to which a line is met by deletions of letters.
TINY = 14
#: Letters of what differs above which a bound from the distance in words is tried before the distance in letters.
LONG = 2_000
#: Lines of a block that are paired with the whole block at once, about; the others of them are paired in other tasks.
DEALT = 256
#: Lines whose keys may be broadcast to prune the second scan (24 bytes each); beyond it the scan is joined by shuffle.
BROADCAST_KEYS = 500_000


def normal(line: Column) -> Column:
    """A lower-case line with its white space folded; the expression runs only on lines that need it."""
    odd = line.contains("  ") | line.contains("\t") | line.contains("\r") | line.contains("\u00a0")
    return F.trim(F.when(odd, F.regexp_replace(line, r"(?U)\s+", " ")).otherwise(line))


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t, text): a row is known by its key and a hash of its text; a null key is the least one, told apart in the hash."""
    return docs.select(*_identity(key, text), F.coalesce(F.col(text), F.lit("")).alias("text"))


def _identity(key: str, text: str) -> list[Column]:
    k = F.col(key).cast("long")
    return [F.coalesce(k, F.lit(-(1 << 63))).alias("k"), F.xxhash64(F.coalesce(F.col(text), F.lit("")), k.isNull()).alias("t")]


def _lines(rows: DataFrame) -> DataFrame:
    """(k, t, i, norm) of every line that is not blank."""
    lines = rows.select("k", "t", F.posexplode(F.split(F.lower("text"), "\n")).alias("i", "line")).where(F.col("line").rlike(r"(?U)\S"))
    return lines.select("k", "t", "i", normal(F.col("line")).alias("norm"))


def _least(hashes: Column, size: int) -> Column:
    """The `size` least distinct hashes; a few repeats among the very least may leave fewer."""
    return F.slice(F.array_distinct(F.slice(F.sort_array(hashes), 1, REPEATS)), 1, size)


def _pairs_sketch(words: Column) -> Column:
    """Least hashes of the pairs of following words, telling pairs first: SKETCH of the line's first half, then of its second.

    Lines that share no more than a passage share it in one half, or seldom across the middle, and so do not meet.
    """
    low, high, n = F.lit((1 << 62) - 1), F.lit(1 << 62), F.greatest(F.size(words) - 1, F.lit(0))

    def hashed(w: Column, v: Column) -> Column:
        h = F.xxhash64(w, v).bitwiseAND(low)
        return F.when(F.octet_length(w) + F.octet_length(v) >= TELLING, h).otherwise(h.bitwiseOR(high))

    half = F.floor((n + 1) / 2).cast("int")

    def least(start: Column, size: Column) -> Column:
        return _least(F.zip_with(F.slice(words, start, size), F.slice(words, start + 1, size), hashed), SKETCH)

    return F.struct(least(F.lit(1), half).alias("head"), least(half + 1, n - half).alias("tail"))


def _letters_sketch(line: Column) -> Column:
    """Least hashes of the groups of GROUP letters."""
    padded = F.concat(F.lit(" "), line, F.lit(" "))
    return _least(F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - GROUP + 1, F.lit(1))), lambda i: F.xxhash64(F.substring(padded, i, F.lit(GROUP)))), LETTERED[0])


def _crossed(sketch: str) -> Column:
    """One key for each element of the first half's sketch with each of the second half's."""
    head, tail = F.col(f"{sketch}.head"), F.col(f"{sketch}.tail")
    keys = [F.when((F.size(head) > x) & (F.size(tail) > y), F.xxhash64(F.lit("pairs"), F.get(head, F.lit(x)), F.get(tail, F.lit(y)))) for x in range(SKETCH) for y in range(SKETCH)]
    return F.filter(F.array(*keys), lambda k: k.isNotNull())


def _subsets(sketch: Column, name: str, first: int, size: int) -> Column:
    """One key for each subset of `size` of a sketch's `first` elements, as far as it has them."""
    keys = [F.when(F.size(sketch) > max(c), F.xxhash64(F.lit(name), *(F.get(sketch, F.lit(x)) for x in c))) for c in combinations(range(first), size)]
    return F.filter(F.array(*keys), lambda x: x.isNotNull())


def _word_deletions(line: Column) -> Column:
    """Keys of a short line and of what each deletion of one word leaves, where that is most of the letters."""
    words = F.split(line, " ")
    left = F.transform(words, lambda w, i: F.when(F.length(w) * 3 <= F.length(line), F.xxhash64(F.lit("words"), F.array_join(F.filter(words, lambda v, j: j != i), " "))))
    return F.concat(F.array(F.xxhash64(F.lit("words"), line)), F.filter(left, lambda x: x.isNotNull()))


def _deletions(line: Column) -> Column:
    """Keys of a tiny line and of what is left when up to a fifth of its letters go, so all its pairs meet."""
    most = F.floor((1 - SIMILARITY) * F.length(line) + 1e-9)
    fewer = lambda texts: F.array_distinct(F.flatten(F.transform(texts, lambda t: F.transform(F.sequence(F.lit(0), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i), F.substring(t, i + 2, F.length(t)))))))
    left = reduce(lambda texts, n: F.when(most >= n, fewer(texts)).otherwise(texts), range(1, int((1 - SIMILARITY) * TINY + 1e-9) + 1), F.array(line))
    return F.transform(left, lambda t: F.xxhash64(F.lit("deletions"), t))


def _rests(pairs: DataFrame) -> DataFrame:
    """(a, b, x, y, rest_x, rest_y, allowed, gap): the words of norm_a and norm_b, what differs of them, the distance that is near, and the gap in length.

    Words that both lines open or close with leave the distance as it is and are cut off.
    """
    allowed = F.floor((1 - SIMILARITY) * F.greatest(F.length("norm_a"), F.length("norm_b")) + 1e-9).cast("int")
    rows = pairs.select("a", "b", F.split("norm_a", " ").alias("x"), F.split("norm_b", " ").alias("y"), allowed.alias("allowed"), F.abs(F.length("norm_a") - F.length("norm_b")).alias("gap"))
    shorter = F.least(F.size("x"), F.size("y"))

    def agreeing(x: Column, y: Column) -> Column:
        """How many leading words agree."""
        apart = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(apart == 0, shorter).otherwise(F.least(apart.cast("int") - 1, shorter))

    rows = rows.withColumn("front", agreeing(F.col("x"), F.col("y"))).withColumn("tail", agreeing(F.reverse("x"), F.reverse("y")))
    rows = rows.withColumn("tail", F.least("tail", shorter - F.col("front")))
    rest = lambda c: F.array_join(F.slice(c, F.col("front") + 1, F.size(c) - F.col("front") - F.col("tail")), " ")
    return rows.withColumn("rest_x", rest("x")).withColumn("rest_y", rest("y")).drop("front", "tail")


def _within(most: Column) -> Column:
    """Whether rest_x and rest_y are at most so far apart: the banded distance of commons-lang, or Spark's where a letter is two units in UTF-16."""
    wide = F.concat_ws(" ", "rest_x", "rest_y").rlike(r"[\x{10000}-\x{10FFFF}]")
    units = F.reflect(F.lit("org.apache.commons.lang3.StringUtils"), F.lit("getLevenshteinDistance"), F.col("rest_x"), F.col("rest_y"), most)
    return F.when(wide, F.levenshtein("rest_x", "rest_y") <= most).otherwise(units.cast("int") >= 0)


def _same(pairs: DataFrame) -> DataFrame:
    """(a, b, same): edit similarity of at least SIMILARITY between norm_a and norm_b, for pairs that may well be near.

    The distance of the rests is at most the longer rest, with as many words on both sides at most what the differing words add up to, and
    at most the distance in words times the longest word and its blank; only where no bound settles it does the banded distance
    run, on the rests, in letters at every length.
    """
    rows = _rests(pairs)
    rows = rows.withColumn("longer", F.greatest(F.length("rest_x"), F.length("rest_y")) + 1)  # and a blank
    swapped = F.aggregate(F.zip_with("x", "y", lambda p, q: F.when(p.eqNullSafe(q), 0).otherwise(F.greatest(F.length(p), F.length(q)))), F.lit(0), lambda s, d: s + d)
    rows = rows.withColumn("long", F.greatest(F.length("rest_x"), F.length("rest_y")) > LONG)

    def hashed(text: Column | str) -> Column:
        return F.transform(F.split(text, " "), lambda w: 65_536 + F.pmod(F.xxhash64(w), F.lit(983_040)))  # beyond the surrogates

    def symbols(text: str) -> Column:
        return F.decode(F.unhex(F.array_join(F.transform(hashed(text), lambda h: F.lpad(F.hex(h), 8, "0")), "")), "UTF-32")

    both = F.concat_ws(" ", "rest_x", "rest_y")
    told = F.size(F.array_distinct(F.split(both, " "))) == F.size(F.array_distinct(hashed(both)))  # no two words share a symbol
    longest = F.array_max(F.transform(F.split(both, " "), lambda w: F.length(w))) + 1  # and a blank
    for c in ("x", "y"):
        rows = rows.withColumn(f"words_{c}", F.when(F.col("long") & (F.col(f"rest_{c}") != ""), symbols(f"rest_{c}")))
    rows = rows.withColumn("few", F.when(F.col("long") & told, F.floor(F.col("allowed") / longest).cast("int")))
    same = (
        F.when(F.col("rest_x") == F.col("rest_y"), True).when(F.col("gap") > F.col("allowed"), False).when(F.col("longer") <= F.col("allowed"), True)
        .when((F.col("rest_x") == "") | (F.col("rest_y") == ""), False)  # the whole rest and its blank went or came
        .when((F.size("x") == F.size("y")) & (swapped <= F.col("allowed")), True)
        .when(F.col("few").isNotNull() & F.expr("levenshtein(words_x, words_y, few) >= 0"), True)
        .when(_within(F.floor(F.col("allowed") / 3).cast("int")), True)  # a narrow band settles most near ones
        .otherwise(_within(F.col("allowed")))
    )
    return rows.select("a", "b", same.alias("same"))


def _near(pairs: DataFrame) -> DataFrame:
    """(a, b, same) as of `_same`, for pairs that are seldom near: no bound that only a near pair meets is tried, the distance runs once."""
    rows = _rests(pairs)
    longer = F.greatest(F.length("rest_x"), F.length("rest_y")) + 1  # and a blank
    same = (
        F.when(F.col("rest_x") == F.col("rest_y"), True).when(F.col("gap") > F.col("allowed"), False).when(longer <= F.col("allowed"), True)
        .when((F.col("rest_x") == "") | (F.col("rest_y") == ""), False).otherwise(_within(F.col("allowed")))
    )
    return rows.select("a", "b", same.alias("same"))


def _texts(ends: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """(cid, norm) of the given class numbers, from the text of each class's first line; no other line is normalised again."""
    wanted = cut(classes.join(ends, "cid", "left_semi").select("cid", "k", "t", "i"))
    few = wanted.count() <= BROADCAST_KEYS
    places = wanted.groupBy(F.col("k").alias("wk"), F.col("t").alias("wt")).agg(F.collect_list(F.struct("i", "cid")).alias("places"))  # at most a document's lines
    hit = (F.col("k") == F.col("wk")) & (F.col("t") == F.col("wt"))
    met = rows.join(F.broadcast(places) if few else places, hit).select(F.split(F.lower("text"), "\n").alias("lines"), "places")
    texts = met.select("lines", F.explode("places").alias("p")).select(F.col("p.cid").alias("cid"), F.get("lines", F.col("p.i")).alias("line"))
    texts = texts.select("cid", normal(F.col("line")).alias("norm"))
    return texts.groupBy("cid").agg(F.min("norm").alias("norm"))  # repeated rows


def _compare(pairs: DataFrame, texts: DataFrame, how: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(a, b, same) for pairs of class numbers, materialised: a filter on `same` would be moved below the exchange and compute it there, more than once."""
    one, two = (texts.select(F.col("cid").alias(c), F.col("norm").alias(f"norm_{c}")) for c in "ab")
    # dealt anew by pair: a few long lines are most of the work
    return cut(how(pairs.join(one, "a").join(two, "b").repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "a", "b")))


def line_classes(rows: DataFrame) -> DataFrame:
    """Classes of equal normal lines: (cid, k, t, i) of the first place, letters (null without one), a short line's words, and the sketch."""
    words = F.split("norm", " ")
    lines = _lines(rows).select("*", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit("second half"), "norm").alias("h2"), words.alias("words"))
    letters = F.when(F.col("norm").rlike(r"\p{L}"), F.length("norm"))
    short = F.when(F.size("words") <= SHORT, F.col("norm"))
    facts = lines.select("h1", "h2", F.struct("k", "t", "i", letters.alias("letters"), short.alias("short"), _pairs_sketch(F.col("words")).alias("sketch")).alias("place"))
    first = facts.groupBy("h1", "h2").agg(F.min("place").alias("first"))
    return first.select(F.monotonically_increasing_id().alias("cid"), "first.*")


def _blocks(classes: DataFrame) -> DataFrame:
    """(bucket, a, b, size): every class b of a block beside the block's hub a, for blocks of two classes or more."""
    none = F.array().cast("array<bigint>")
    tiny, lettered = F.col("letters") <= TINY, F.size(F.split("short", " ")) <= FEW
    able = classes.where("letters is not null").select("cid", "letters", "short", "sketch")
    able = able.withColumn("grams", F.when(lettered & ~tiny, _letters_sketch(F.col("short"))))
    keys = F.concat(
        _crossed("sketch"),
        F.when(F.col("short").isNotNull(), _word_deletions(F.col("short"))).otherwise(none),
        F.when(lettered & tiny, _deletions(F.col("short"))).otherwise(none),
        F.when(F.col("grams").isNotNull(), _subsets(F.col("grams"), "letters", *LETTERED)).otherwise(none),
    )
    met = able.select("cid", F.explode(keys).alias("bucket")).distinct()
    met = met.withColumn("size", F.count("*").over(Window.partitionBy("bucket"))).where("size > 1")
    met = stored(met, "line-meetings")
    # the hub is the class that meets most others: the text that copies were made from, rather than one of them
    degree = met.groupBy("cid").agg(F.sum("size").alias("degree"))
    met = met.join(degree, "cid")
    hubs = met.groupBy("bucket").agg(F.max_by("cid", F.col("degree") * 1000 + F.pmod(F.xxhash64("cid"), F.lit(1000))).alias("a"))
    return met.join(hubs, "bucket").select("bucket", "a", F.col("cid").alias("b"), "size")


def _alike(a: str, b: str) -> Column:
    """Lengths that the similarity allows."""
    return F.abs(F.col(a) - F.col(b)) <= F.floor((1 - SIMILARITY) * F.greatest(a, b) + 1e-9)


def line_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Classes of equal normal lines, each with its first place (k, t, i), and the class numbers that a near line replaces.

    Lines in one block are compared with the block's hub; those that it does not link, compared or not, are
    compared with all others of the block that no link has joined to them yet, whatever the block's size. Nothing is
    capped or left out, so the work grows with the square of a block's unlinked lines.
    """
    rows = _documents(docs, key, text)
    classes = stored(line_classes(rows), "line-classes")
    met = stored(_blocks(classes), "line-blocks")
    texts = stored(_texts(met.select(F.col("b").alias("cid")).distinct(), classes, rows), "line-texts")
    letters = classes.select("cid", "letters")
    apart = met.where("a <> b").select("a", "b").distinct()
    apart = apart.join(letters.toDF("a", "letters_a"), "a").join(letters.toDF("b", "letters_b"), "b")
    apart = cut(apart.where(_alike("letters_a", "letters_b")).select("a", "b"))
    compared = _compare(apart, texts, _same)
    links = compared.where("same").select("a", "b")

    unlinked = met.where("size > 2 and a <> b").join(links, ["a", "b"], "left_anti").select("bucket", "b")
    unlinked = cut(unlinked)
    if not unlinked.isEmpty():
        named = connected_components(links, "a", "b").select(F.col("node").alias("b"), "component")
        around = met.join(unlinked.select("bucket").distinct(), "bucket", "left_semi").drop("a").join(named, "b", "left").join(letters.withColumnRenamed("cid", "b"), "b")
        around = around.join(unlinked.withColumn("missed", F.lit(True)), ["bucket", "b"], "left")
        around = cut(around.select("bucket", F.col("b").alias("cid"), "letters", F.ceil(F.col("size") / DEALT).cast("int").alias("parts"), F.coalesce("component", "b").alias("group"), F.coalesce("missed", F.lit(False)).alias("missed")))
        x, y = (around.select("bucket", "parts", *(F.col(c).alias(f"{c}_{s}") for c in ("cid", "letters", "group", "missed"))) for s in "xy")
        x = x.where("missed_x").withColumn("part", F.pmod(F.xxhash64("cid_x"), F.col("parts")).cast("int")).drop("parts")
        y = y.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        able = (F.col("group_x") != F.col("group_y")) & (~F.col("missed_y") | (F.col("cid_x") < F.col("cid_y"))) & _alike("letters_x", "letters_y")
        pairs = x.join(y, ["bucket", "part"]).where(able).select(F.least("cid_x", "cid_y").alias("a"), F.greatest("cid_x", "cid_y").alias("b")).distinct()
        pairs = cut(pairs.join(compared.select("a", "b"), ["a", "b"], "left_anti"))
        if not pairs.isEmpty():
            links = links.union(_compare(pairs, texts, _near).where("same").select("a", "b"))
    grouped = connected_components(links, "a", "b").select(F.col("node").alias("cid"), "component")
    placed = grouped.join(classes, "cid").select("cid", "component", F.struct("k", "t", "i").alias("place"))
    kept = placed.groupBy("component").agg(F.min("place").alias("kept"))
    replaced = placed.join(kept, "component").where(~F.col("place").eqNullSafe(F.col("kept"))).select("cid")
    return classes, cut(replaced)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns of `docs`, each text without the lines that another place keeps; adds n_lines and n_dropped.

    Of every group of equal or similar lines the first place stays, in order of key, text hash and line number.
    Lines without a letter are one group only if they are equal up to white space; blank lines always stay. Null text
    stays null. Of rows that repeat key and text the first is the document; the others lose all lines but blank
    ones. Null keys come first. An empty table gives an empty result. Other columns pass through, whatever
    their names; where `docs` has an n_lines or n_dropped already, the new one gets an underscore in front.
    """
    classes, replaced = line_groups(docs, key, text)
    kept = classes.join(replaced, "cid", "left_anti").groupBy("k", "t").agg(F.collect_list("i").alias("kept"))
    rows = docs.select(F.struct("*").alias("row"), *_identity(key, text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    none = F.array().cast("array<int>")
    copies = Window.partitionBy("k", "t").orderBy("t")
    joined = rows.join(kept, ["k", "t"], "left").withColumn("kept", F.when(F.row_number().over(copies) == 1, F.coalesce("kept", none)).otherwise(none))
    split = joined.select("row", "kept", F.split("text", "\n").alias("lines"))
    blank = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: ~F.get("lines", i).rlike(r"(?U)\S"))
    chosen = split.select("row", "lines", F.sort_array(F.concat("kept", blank)).alias("chosen"))
    out = F.array_join(F.transform("chosen", lambda i: F.get("lines", i)), "\n")
    columns = [F.when(F.col(f"row.`{c}`").isNotNull(), out).alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    names = ["n_lines", "n_dropped"]
    while set(names) & set(docs.columns):
        names = [f"_{n}" if n in docs.columns else n for n in names]
    return chosen.select(*columns, F.size("lines").cast("long").alias(names[0]), (F.size("lines") - F.size("chosen")).cast("long").alias(names[1]))
