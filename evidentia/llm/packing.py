"""Operator 3: packing token sequences by cutting-stock column generation over a length histogram."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.llm.bpe import TOGETHER, memo_of, portions
from evidentia.session import cut

SEQUENCE = 2048
#: Tokens per length class; a power of two. The histogram has SEQUENCE / CLASS classes, whatever the input.
CLASS = 8
#: The linear program stops within this share of the lower bound that the tokens alone give.
GAP = 0.001
#: Pieces per ranking group; groups are salted so that one length class never meets in one task.
RANKED_TOGETHER = 5_000


def knapsack(values: np.ndarray) -> tuple[float, np.ndarray]:
    """Best multiset of class sizes 1..n (in units) within n units, by dynamic programming."""
    n = len(values)
    best, choice = np.zeros(n + 1), np.zeros(n + 1, dtype=np.int64)
    for room in range(1, n + 1):
        got = best[room - 1 :: -1] + values[:room]
        at = int(np.argmax(got))
        best[room] = best[room - 1]
        if got[at] > best[room] + 1e-12:  # else a unit stays empty: worthless items must not slip in
            best[room], choice[room] = got[at], at + 1
    counts, room = np.zeros(n, dtype=np.int64), n
    while room > 0:
        if choice[room]:
            counts[choice[room] - 1] += 1
        room -= max(1, choice[room])
    return float(best[n]), counts


def times_vector(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """matrix @ vector without a linear-algebra library, whose threads may hang in a process that has forked the JVM's launcher."""
    return (matrix * vector).sum(axis=1)


def inverse_of(columns: np.ndarray) -> np.ndarray:
    """The inverse by elimination with row exchanges, for the same reason in plain array operations."""
    m = len(columns)
    left, right = columns.astype(float), np.eye(m)
    for k in range(m):
        top = k + int(np.argmax(np.abs(left[k:, k])))
        for side in (left, right):
            side[[k, top]] = side[[top, k]]
        scale = left[k, k]
        left[k], right[k] = left[k] / scale, right[k] / scale
        factor = left[:, k].copy()
        factor[k] = 0.0
        left -= np.outer(factor, left[k])
        right -= np.outer(factor, right[k])
    return right


def solve_patterns(demand: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(sequences, items per class) that use every item once, from the linear program's rounded optimum.

    demand[k] counts items of k+1 units; a sequence holds len(demand) units. Columns enter while the priced
    knapsack beats 1, until the optimum or GAP; every basis met on the way is feasible, so an early numeric stop costs padding only.
    """
    units = len(demand)
    have = np.flatnonzero(demand > 0)
    if not len(have):
        return []
    m = len(have)
    fit = units // (have + 1)
    columns = np.diag(fit.astype(float))
    inverse = np.diag(1.0 / fit)
    amount = demand[have] / fit
    least = (demand * np.arange(1, units + 1)).sum() / units  # no packing has fewer sequences
    for step in range(40 * m):
        if amount.sum() <= least * (1 + GAP):
            break
        prices = np.zeros(units)
        prices[have] = inverse.sum(axis=0)
        value, counts = knapsack(np.maximum(prices, 0.0))
        counts = counts * (demand > 0)
        if (prices[have] * counts[have]).sum() <= 1 + 1e-7:
            break
        entering = counts[have].astype(float)
        direction = times_vector(inverse, entering)
        ok = direction > 1e-9
        if not ok.any():
            break
        ratio = np.where(ok, amount / np.where(ok, direction, 1.0), np.inf)
        leave = int(np.argmin(ratio))
        move = ratio[leave]
        amount = np.maximum(amount - move * direction, 0.0)
        amount[leave] = move
        columns[:, leave] = entering
        pivot = inverse[leave] / direction[leave]
        inverse -= np.outer(direction, pivot)
        inverse[leave] = pivot
        if step % 200 == 199:  # shed rounding errors
            inverse = inverse_of(columns)
            amount = np.maximum(times_vector(inverse, demand[have]), 0.0)
    times = np.floor(amount + 1e-6).astype(np.int64)
    left = demand[have] - times_vector(columns, times).astype(np.int64)
    while (left < 0).any():  # a count rounded up too far
        k = int(np.flatnonzero((columns[np.flatnonzero(left < 0)[0]] > 0) & (times > 0))[0])
        times[k] -= 1
        left = demand[have] - times_vector(columns, times).astype(np.int64)
    out = []
    for k in np.flatnonzero(times):
        counts = np.zeros(units, dtype=np.int64)
        counts[have] = columns[:, k].astype(np.int64)
        out.append((int(times[k]), counts))
    # what rounding leaves is a few items per column: largest first into the fullest open sequence that takes it
    open_: list[tuple[int, np.ndarray]] = []
    for j in range(m - 1, -1, -1):
        size = int(have[j]) + 1
        for _ in range(int(left[j])):
            fits = [k for k, (room, _) in enumerate(open_) if room >= size]
            if fits:
                k = min(fits, key=lambda k: open_[k][0])
            else:
                open_.append((units, np.zeros(units, dtype=np.int64)))
                k = len(open_) - 1
            open_[k][1][size - 1] += 1
            open_[k] = (open_[k][0] - size, open_[k][1])
    return out + [(1, counts) for _, counts in open_]


def pieces_of(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = 1, keep_ids: bool = False, together: int = TOGETHER) -> DataFrame:
    """Cut every document's ids and the end id into full sequences and one remainder.

    (key, start, length, ids_crc32, doc_tokens[, ids]). The ids are the tokenizer's own; a worker keeps those of recent chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = memo_of(tokenizer_path)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for part, split in portions(batch, together=together):
                memo.learn(set().union(*split))
                rows: list[list] = [[], [], [], [], [], []]
                for k, chunks_ in enumerate(split):
                    ids = b"".join(map(memo.ids.__getitem__, chunks_)) + end
                    total = len(ids) // 4
                    for start in range(0, total, SEQUENCE):
                        raw = ids[4 * start : 4 * (start + SEQUENCE)]
                        for column, value in zip(rows, (k, start, len(raw) // 4, zlib.crc32(raw), total, raw if keep_ids else None)):
                            column.append(value)
                keys = part.column(0).take(pa.array(rows[0], pa.int64()))
                longs = [pa.array(c, pa.int64()) for c in rows[1:5]]
                names = ["key", "start", "length", "ids_crc32", "doc_tokens"]
                extra = [pa.array(rows[5], pa.binary())] if keep_ids else []
                memo.shed()
                yield pa.RecordBatch.from_arrays([keys, *longs, *extra], names + ["ids"] * keep_ids)

    plain = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = plain.schema["key"].dataType.simpleString()
    schema = f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * keep_ids
    return plain.mapInArrow(run, schema).withColumnRenamed("key", key)


def assign(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """Give every piece a sequence and an offset there.

    Only the histogram of length classes reaches the driver. A piece's rank in its class (documents ranked by
    key) picks its pattern, copy and place by arithmetic. Adds sequence_id, offset and padded, the sequence's
    length with padding: none at a power of two, else up to SEQUENCE.
    """
    spark = pieces.sparkSession
    classed = pieces.withColumn("class", F.ceil(F.col("length") / CLASS).cast("int"))
    histogram = {r["class"]: r["n"] for r in classed.groupBy("class").agg(F.count("*").alias("n")).collect()}
    units = SEQUENCE // CLASS
    plan, base = [], 0
    starts = dict.fromkeys(range(1, units + 1), 0)
    if full := histogram.get(units, 0):
        plan.append((units, 0, 1, full, 0))
        base = full
    demand = np.array([histogram.get(k, 0) for k in range(1, units + 1)], dtype=np.int64)
    demand[units - 1] = 0
    for times, counts in solve_patterns(demand):
        for k in np.flatnonzero(counts):
            n = int(counts[k])
            plan.append((int(k) + 1, starts[int(k) + 1], n, times, base))
            starts[int(k) + 1] += n * times
        base += times
    # a few rows per class: bounded by the number of classes, whatever the input
    table = F.broadcast(spark.createDataFrame(plan, "p_class int, p_start long, p_each long, p_times long, p_base long"))

    salts = max(1, -(-sum(histogram.values()) // RANKED_TOGETHER))
    salted = classed.withColumn("salt", F.pmod(F.xxhash64(key, "start", "ids_crc32"), F.lit(salts)))
    before = (
        salted.groupBy("class", "salt").agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("class").orderBy("salt")) - F.col("n"))
        .select(F.col("class").alias("b_class"), F.col("salt").alias("b_salt"), "before")
    )
    within = Window.partitionBy("class", "salt").orderBy(key, "start", "ids_crc32")
    ranked = (
        salted.withColumn("rank", F.row_number().over(within) - 1)
        .join(before, (F.col("class") == F.col("b_class")) & (F.col("salt") == F.col("b_salt")))
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    at = (F.col("class") == F.col("p_class")) & (F.col("rank") >= F.col("p_start"))
    placed = ranked.join(table, at & (F.col("rank") < F.col("p_start") + F.col("p_each") * F.col("p_times")))
    placed = placed.withColumn("sequence_id", F.expr("p_base + (rank - p_start) div p_each"))
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("length"), key, "start", "rank")
    total = F.sum("length").over(Window.partitionBy("sequence_id"))
    return (
        placed.withColumn("offset", F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length"))
        .withColumn("padded", F.when(F.bit_count(total) == 1, total).otherwise(F.lit(SEQUENCE)).cast("long"))
        .select(*pieces.columns, "sequence_id", "offset", "padded")
    )


def pack(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False, together: int = TOGETHER) -> DataFrame:
    """Pack all documents into sequences of at most SEQUENCE tokens: one row per piece.

    Null text is an empty document (its end id alone); repeated rows and null keys are packed as they come;
    columns other than key and text are not read; an empty table gives an empty result.
    `together` is how many characters a worker splits and merges at once: fewer take less memory and more time.
    """
    return assign(cut(pieces_of(docs, tokenizer_path, key, text, keep_ids=keep_ids, together=together)), key)
