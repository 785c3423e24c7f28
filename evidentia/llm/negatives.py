"""Operator 11: hard-negative mining with coordinate pruning inside length buckets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evidentia.session import cut, stored

#: Rows of an anchor block and of a candidate cell; the labels' groups; the anchor coordinates whose ranges are intersected.
ANCHOR_ROWS, CELL_ROWS, GROUPS, FOCUS = 256, 1024, 16, 6
#: Length buckets in an octave of the squared length.
STEPS = 4
#: A part's generation is the power of this that its number lies under; each generation tightens the next one's thresholds.
FANOUT = 8
#: Shares that a generation's cells are dealt over at most, and anchor blocks that one share meets at once.
SHARES, TOGETHER = 128, 64
#: Components are held within this, so that a hundred times any score of 2^13 components fits a long.
REACH = float(1 << 21)
_LEAST, _MOST = -(1 << 62), 1 << 62


def _matrix(vectors: pa.Array) -> np.ndarray:
    """A list array of integer vectors as a matrix; shorter vectors end in zeros."""
    ends = vectors.offsets.to_numpy()
    lengths, flat = np.diff(ends), vectors.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), dtype=np.int32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat[ends[0] : ends[-1]]
    return out


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of rows to cells with a sorted list for every coordinate: the rows in order of the unit vectors' value there."""
    for batch in batches:
        for at in range(len(batch)):
            rows = batch.column(2)[at].values
            matrix = _matrix(rows.field("v"))
            lengths = np.sqrt((matrix.astype(float) ** 2).sum(axis=1))
            unit = matrix / np.maximum(lengths, 1)[:, None]
            lists = np.argsort(unit, axis=0, kind="stable").T.astype(np.int16 if len(matrix) < 1 << 15 else np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[at : at + 1],
                    batch.column(1)[at : at + 1],
                    *(pa.array([x.tobytes()], pa.binary()) for x in (rows.field("id").to_numpy(), rows.field("label").to_numpy(), matrix, np.ascontiguousarray(lists))),
                    pa.array([float(lengths.max())]),
                    pa.array([len(matrix)], pa.int32()),
                ],
                ["group", "part", "ids", "labels", "matrix", "lists", "longest", "rows"],
            )


class Cell:
    """One length bucket's part: vectors of like length, with a sorted list for each coordinate."""

    def __init__(self, row: dict):
        n = row["rows"]
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int32)
        self.matrix = np.frombuffer(row["matrix"], np.int32).reshape(n, -1)
        self.lists = np.frombuffer(row["lists"], np.int16 if n < 1 << 15 else np.int32).reshape(-1, n)
        self.longest = row["longest"]
        lengths = np.sqrt((self.matrix.astype(float) ** 2).sum(axis=1))
        self.unit = self.matrix / np.maximum(lengths, 1)[:, None]
        self.values: dict[int, np.ndarray] = {}

    def feasible(self, q: np.ndarray, low: int) -> np.ndarray:
        """Rows that may score `low` or more with q: those inside the range of every focus coordinate of q.

        If the angle between q and a row is at most c, and q makes the angle a with an axis, the row's angle with
        that axis lies within a - c and a + c, and so its unit value within the cosines of these.
        """
        everything = np.arange(len(self.ids))
        length = float(np.sqrt((q.astype(float) ** 2).sum()))
        if low <= 0:
            return everything
        if length * self.longest * (1 + 1e-9) < low:
            return everything[:0]
        c = np.arccos(min(1.0, low / (length * self.longest)))
        unit = q / length
        inside, lists = None, 0
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS].tolist():
            a = np.arccos(np.clip(unit[f], -1, 1))
            least = np.cos(a + c) - 1e-9 if a + c < np.pi else -2.0
            most = np.cos(a - c) + 1e-9 if a > c else 2.0
            if f >= self.unit.shape[1]:  # beyond the cell's width every value is 0
                if least > 0 or most < 0:
                    return everything[:0]
                continue
            order = self.lists[f]
            if f not in self.values:
                self.values[f] = self.unit[order, f]
            span = order[np.searchsorted(self.values[f], least, "left") : np.searchsorted(self.values[f], most, "right")]
            if len(span) < len(order):
                inside = np.zeros(len(order), dtype=np.int8) if inside is None else inside
                inside[span] += 1
                lists += 1
        return everything if inside is None else np.flatnonzero(inside == lists)

    def scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        width = min(len(q), self.matrix.shape[1])
        return self.matrix[rows, :width].astype(np.int64) @ q[:width].astype(np.int64)


def _mine(k: int, same: bool):
    """Pairs of an anchor block and a cell to each anchor's k best rows of the cell within each of its bounds."""

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at_ in range(len(batch)):
                row = batch.slice(at_, 1).to_pylist()[0]
                cell, out = Cell(row), []
                for anchor in row["anchors"]:
                    q = np.array(anchor["v"], dtype=np.int64)
                    rows = cell.feasible(q, min(b["low"] for b in anchor["bounds"]))
                    rows = rows[((cell.labels[rows] == anchor["label"]) == same) & (cell.ids[rows] != anchor["id"])]
                    if not len(rows):
                        continue
                    scores, ids = cell.scores(q, rows), cell.ids[rows]
                    for b in anchor["bounds"]:
                        at = np.flatnonzero((scores >= b["low"]) & (scores <= b["high"]))
                        if len(at) > k:  # no row below the k-th score, then ties by id
                            kth = np.partition(scores[at], len(at) - k)[len(at) - k]
                            at = at[scores[at] >= kth]
                        at = at[np.lexsort((ids[at], -scores[at]))][:k]
                        out.append(np.stack([np.full(len(at), anchor["id"]), np.full(len(at), b["tag"]), ids[at], scores[at]]))
                got = np.concatenate(out, axis=1) if out else np.zeros((4, 0), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], ["anchor", "tag", "other", "score"])

    return mine


def _best(found: DataFrame, k: int) -> DataFrame:
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor", "tag").orderBy(F.desc("score"), "other")))
    return ranked.where(F.col("rank") <= k)


def _generation(part: Column) -> Column:
    return F.when(part == 0, 0).otherwise(1 + F.floor(F.log(part + 0.5) / float(np.log(FANOUT)))).cast("int")


def _search(anchors: DataFrame, bounds: DataFrame, cells: DataFrame, sizes: dict[int, int], generations: dict[int, int], k: int, same: bool) -> DataFrame:
    """(anchor, tag, other, score, rank): the k best rows of every bound (anchor, tag, low, high), ties by smaller key.

    `same` asks for rows of the anchor's label, otherwise for rows of any other. The cells come in generations of growing number; after
    each one a bound that has k rows is raised to the k-th score, which narrows the ranges of the next. Cells are dealt over shares, and every share gets
    each anchor block; cells travel once for TOGETHER blocks, and neither side is ever whole on the driver.
    """
    spark, best = anchors.sparkSession, None
    firsts, total = {}, 0
    for g, n in sorted(sizes.items()):
        firsts[g], total = total, total + max(1, -(-n // ANCHOR_ROWS))
    number = reduce(lambda c, g: c.when(F.col("group") == g, F.lit(firsts[g]) + F.pmod(F.xxhash64("id"), F.lit(max(1, -(-sizes[g] // ANCHOR_ROWS))))), firsts, F.when(F.lit(False), 0))
    columns = max(1, -(-total // TOGETHER))
    for generation, n_cells in sorted(generations.items()):
        now = bounds
        if best is not None:
            held = best.groupBy("anchor", "tag").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
            now = bounds.join(held.hint("merge"), ["anchor", "tag"], "left").select("anchor", "tag", F.when(F.col("n") >= k, F.greatest("low", "kth")).otherwise(F.col("low")).alias("low"), "high")
        listed = now.groupBy(F.col("anchor").alias("id")).agg(F.collect_list(F.struct("tag", "low", "high")).alias("bounds"))
        shares = max(1, min(n_cells, SHARES))
        at = ["group", "share", "column"] if same else ["share", "column"]
        blocks = anchors.join(listed.hint("merge"), "id").groupBy("group", number.cast("int").alias("block")).agg(F.collect_list(F.struct("id", "label", "v", "bounds")).alias("anchors"))
        blocks = blocks.withColumn("column", F.col("block") % columns).withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).select(*at, "anchors")
        some = cells.where(F.col("generation") == generation).withColumn("share", F.pmod(F.xxhash64("group", "part", "ids"), F.lit(shares)).cast("int"))
        some = some.withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1)))).select(*at, "ids", "labels", "matrix", "lists", "longest", "rows")
        # a block stands in every share, which no estimate knows of: left to Spark, all of them would be broadcast by way of the driver
        pairs = some.join(blocks.hint("merge"), at).select("anchors", "ids", "labels", "matrix", "lists", "longest", "rows")
        found = pairs.mapInArrow(_mine(k, same), "anchor long, tag long, other long, score long")
        best = cut(_best(found if best is None else best.drop("rank").unionByName(found), k))
    return best if best is not None else spark.createDataFrame([], "anchor long, tag long, other long, score long, rank int")


def hard_negatives(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", is_anchor: Column | None = None,
    n_positives: int = 5, n_negatives: int = 10, band: tuple[int, int] = (30, 90), scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A score is the integer inner product of two vectors of floor(scale * x). An anchor's positives are its n_positives best
    other rows of its label; for each, the first n_negatives rows of other labels are returned whose score, times a
    hundred, lies within `band` times the positive's score, both ends included. Higher scores come first, ties by
    smaller key. `is_anchor` is a condition on the inner column `id`, by default id % 100 = 0.

    Rows are bucketed by length and dealt to cells of about CELL_ROWS rows; a cell keeps a sorted list for each
    coordinate. With a score to beat, an anchor meets only rows inside the feasible range of each of its FOCUS
    largest coordinates; those are verified exactly. Every anchor meets every cell, in blocks; the score to
    beat is raised after each generation of cells, so what a cell sends on stays small. Where scores to
    beat are low the ranges span whole lists, and all rows of a cell are verified.

    Rows with a null key, label or vector, or with a null or non-finite component, take no part. Rows are known by their
    key alone, so rows that repeat one count once, by the least label and vector. A shorter vector counts as padded
    with zeros. Components are held within REACH. A positive with a negative score has no negatives. Other columns are
    not read. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    if is_anchor is None:
        is_anchor = F.pmod(F.col("id"), F.lit(100)) == 0
    whole = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where(F.coalesce(whole, F.lit(False))).select(
        F.col(key).cast("long").alias("id"),
        F.col(label).cast("int").alias("label"),
        F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(REACH)), F.lit(-REACH))).cast("int")).alias("v"),
    )
    one = rows.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.*")
    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    placed = one.select("*", F.pmod("label", F.lit(GROUPS)).cast("int").alias("group"), F.floor(F.log2(1 + length) * STEPS).cast("int").alias("bucket"))
    placed = stored(placed, "placed")
    # Buckets and groups are bounded in number whatever the table's size.
    counted = placed.groupBy("group", "bucket").agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors")).collect()
    sizes: dict[int, int] = {}
    for r in counted:
        sizes[r["group"]] = sizes.get(r["group"], 0) + r["anchors"]
    parts = spark.createDataFrame([(r["group"], r["bucket"], -(-r["n"] // CELL_ROWS)) for r in counted], "group int, bucket int, parts int")
    dealt = placed.join(F.broadcast(parts), ["group", "bucket"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    cells = dealt.groupBy("group", "bucket", "part").agg(F.collect_list(F.struct("id", "label", "v")).alias("rows_")).select("group", "part", "rows_")
    cells = stored(cells.mapInArrow(_index, "group int, part int, ids binary, labels binary, matrix binary, lists binary, longest double, rows int").withColumn("generation", _generation(F.col("part"))), "cells")
    generations = {r["generation"]: r["n"] for r in cells.groupBy("generation").agg(F.count("*").alias("n")).collect()}
    anchors = placed.where(is_anchor).select("id", "label", "v", "group")
    base = anchors.select(F.col("id").alias("anchor"), F.lit(0).cast("long").alias("tag"), F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high"))
    positives = _search(anchors, base, cells, sizes, generations, n_positives, True).select("anchor", F.col("other").alias("tag"), F.col("score").alias("positive_score"))
    low = F.expr(f"-((-{band[0]}L * positive_score - pmod(-{band[0]}L * positive_score, 100L)) div 100L)")
    high = F.expr(f"({band[1]}L * positive_score - pmod({band[1]}L * positive_score, 100L)) div 100L")
    bounds = positives.select("anchor", "tag", low.alias("low"), high.alias("high")).where("low <= high")
    found = _search(anchors, bounds, cells, sizes, generations, n_negatives, False)
    return found.join(positives.hint("merge"), ["anchor", "tag"]).select(
        F.col("anchor").alias("anchor_id"), F.col("tag").alias("positive_id"), "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
