"""Operator 2: exact top-k search by distributed histogram selection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evidentia.session import cut

#: Rows of a query block and of a candidate block; a pair of blocks is scored at once.
QUERY_ROWS, CANDIDATE_ROWS = 512, 4096
#: Bins that one pass splits every query's open score interval into.
BINS = 1024
_EXACT = 2.0**53  # integers below this are exact in doubles


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, id, vector) sorted by block to one row per block."""
    block, ids, vectors = None, [], []

    def flush() -> pa.RecordBatch:
        width = max(map(len, vectors))
        matrix = np.zeros((len(vectors), width), dtype=np.int64)
        for row, v in zip(matrix, vectors):
            row[: len(v)] = v
        return pa.RecordBatch.from_arrays(
            [pa.array([block], pa.int64()), pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary()), pa.array([width], pa.int32())],
            ["block", "ids", "matrix", "width"],
        )

    for batch in batches:
        for b, i, v in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if b != block and ids:
                yield flush()
                ids, vectors = [], []
            block = b
            ids.append(i)
            vectors.append(v)
    if ids:
        yield flush()


def _blocks(rows: DataFrame, n: int, size: int) -> tuple[DataFrame, int]:
    count = max(1, -(-n // size))
    dealt = rows.select(F.pmod(F.xxhash64("id"), F.lit(count)).alias("block"), "id", "v").repartition("block").sortWithinPartitions("block", "id")
    return cut(dealt.mapInArrow(_pack, "block long, ids binary, matrix binary, width int")), count


def _numbers(n: int):
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _scores(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query ids, candidate ids, integer inner products, and which pairs are a query with itself."""
    q_ids, c_ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["c_ids"], "<i8")
    width = min(row["q_width"], row["c_width"])  # a shorter vector counts as padded with zeros
    q = np.frombuffer(row["q_matrix"], np.int64).reshape(len(q_ids), -1)[:, :width]
    c = np.frombuffer(row["c_matrix"], np.int64).reshape(len(c_ids), -1)[:, :width]
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, width)
    if bound < _EXACT:
        scores = np.rint(q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    else:
        scores = q @ c.T
    return q_ids, c_ids, scores, q_ids[:, None] == c_ids[None, :]


def top_k(vectors: DataFrame, k: int = 20, key: str = "vec_id", vector: str = "embedding", is_query=None, scale: int = 64) -> DataFrame:
    """Each query's k highest integer inner products: (query_id, rank, key, score); ties go to the smaller key.

    Components become floor(scale * x). Every pair is scored in blocks; score histograms per query are summed
    over all blocks and refined until the interval of the k-th score is one value, then scores above it are
    kept and ties at it are filled by smallest key. A block sends only the bins down to its own k-th
    score, as lower bins cannot hold the k-th of all.

    Null vectors, and those holding null or non-finite components, take no part, nor do null keys; rows that
    repeat a key count once, by the smallest vector. `is_query` is a condition on the key, by default
    key % 20 = 0. Fewer than k candidates give all. An empty table gives an empty result.
    """
    if is_query is None:
        is_query = F.pmod(F.col("id"), F.lit(20)) == 0
    whole = F.col(key).isNotNull() & F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (
        vectors.where(F.coalesce(whole, F.lit(False)))
        .select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))
        .groupBy("id").agg(F.min("v").alias("v"))
    )
    rows = cut(rows)
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)).alias("norm")).first()
    candidates, n_c = _blocks(rows, sizes["n"], CANDIDATE_ROWS)
    queries, n_q = _blocks(rows.where(is_query), sizes["q"], QUERY_ROWS)
    c = candidates.select(F.col("block").alias("c_block"), *(F.col(x).alias(f"c_{x}") for x in ("ids", "matrix", "width")), _numbers(n_q).alias("q_block"))
    reach = int(sizes["norm"] or 0) + 2  # by Cauchy-Schwarz no score lies beyond
    low, width = -reach, 2 * reach + 1

    def paired(state: DataFrame | None) -> DataFrame:
        """Every pair of blocks, with the open interval of each query in it."""
        q = queries
        if state is not None:
            at = state.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_q)))
            q = q.join(at.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("id", "low", "above"))).alias("state")), "block")
        else:
            q = q.withColumn("state", F.lit(None).cast("array<struct<id:long,low:long,above:long>>"))
        q = q.select(F.col("block").alias("q_block"), *(F.col(x).alias(f"q_{x}") for x in ("ids", "matrix", "width")), "state", _numbers(n_c).alias("c_block"))
        return q.join(c, ["q_block", "c_block"]).select("q_ids", "q_matrix", "q_width", "state", "c_ids", "c_matrix", "c_width")

    def opened(row: dict, q_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers of the block's queries that still matter, their lows and counts above."""
        if row["state"] is None:
            return np.arange(len(q_ids)), np.full(len(q_ids), low), np.zeros(len(q_ids), dtype=np.int64)
        at = {i: r for r, i in enumerate(q_ids.tolist())}
        kept = [s for s in row["state"] if s["id"] in at]
        return np.array([at[s["id"]] for s in kept], dtype=np.int64), np.array([s["low"] for s in kept], dtype=np.int64), np.array([s["above"] for s in kept], dtype=np.int64)

    def refine(state: DataFrame | None, span: int, step: int) -> DataFrame:
        """Histograms of the open intervals, `span` scores wide, in bins of `step`; then each query's bin that holds its k-th score."""

        def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    q_ids, _, scores, own = _scores(row)
                    rows_, lows, above = opened(row, q_ids)
                    out: list[np.ndarray] = []
                    for r, lo, up in zip(rows_.tolist(), lows.tolist(), above.tolist()):
                        offsets = scores[r][~own[r]] - lo
                        counts = np.bincount(offsets[(offsets >= 0) & (offsets < span)] // step, minlength=BINS)
                        at = np.flatnonzero(counts)[::-1]
                        need = np.searchsorted(np.cumsum(counts[at]), max(1, k - up)) + 1
                        at = at[:need]
                        out.append(np.stack([np.full(len(at), q_ids[r]), np.full(len(at), lo), np.full(len(at), up), at, counts[at]]))
                    got = np.concatenate(out, axis=1) if out else np.zeros((5, 0), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], ["id", "low", "above", "bin", "n"])

        bins = paired(state).mapInArrow(histogram, "id long, low long, above long, bin long, n long").groupBy("id", "low", "above", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("id").orderBy(F.desc("bin"))
        reached = bins.withColumn("total", F.col("above") + F.sum("n").over(down)).withColumn("before", F.col("total") - F.col("n"))
        # the first bin that reaches k; a query with fewer candidates ends in its lowest bin
        first = reached.withColumn("lowest", F.row_number().over(Window.partitionBy("id").orderBy("bin"))).where((F.col("before") < k) & ((F.col("total") >= k) | (F.col("lowest") == 1)))
        return cut(first.select("id", (F.col("low") + F.col("bin") * step).alias("low"), F.col("before").alias("above")))

    state, span = None, width
    while span > 1:
        step = -(-span // BINS)
        state, span = refine(state, span, step), step

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, c_ids, scores, own = _scores(row)
                out: list[np.ndarray] = []
                for r, kth, above in zip(*(x.tolist() for x in opened(row, q_ids))):
                    s = scores[r]
                    over = np.flatnonzero((s > kth) & ~own[r])
                    ties = np.flatnonzero((s == kth) & ~own[r])
                    ties = ties[np.argsort(c_ids[ties], kind="stable")][: max(0, k - above)]
                    at = np.concatenate([over, ties])
                    out.append(np.stack([np.full(len(at), q_ids[r]), c_ids[at], s[at]]))
                got = np.concatenate(out, axis=1) if out else np.zeros((3, 0), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], ["query_id", "cid", "score"])

    found = paired(state).mapInArrow(take, "query_id long, cid long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "cid")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("cid").alias(key), "score")
