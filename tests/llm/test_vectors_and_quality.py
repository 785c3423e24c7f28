"""Hard negatives, the quality classifier and centroid clustering against brute force and held-out labels; odd rows and empty tables."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from evidentia.llm import centroids, negatives, quality, queries

VECTORS = "vec_id long, embedding array<float>, label int, part int, bucket string"


def vectors_of(spark, rows):
    """Rows (vec_id, embedding, label) with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, v, y, 1, "x") for i, v, y in rows], VECTORS)


def integers(v, scale):
    return [int(np.floor(float(x) * scale)) for x in v]


def mined(rows, scale=256, n_positives=5, n_negatives=10):
    """Hard negatives by scoring everything."""
    whole = {}
    for i, v, y in rows:
        if i is not None and v is not None and y is not None and all(x is not None and np.isfinite(x) for x in v):
            here = (y, integers(v, scale))
            whole[i] = min(whole.get(i, here), here)
    out = set()
    for a in (i for i in whole if i % 100 == 0):
        label, q = whole[a]
        scored = sorted((-sum(x * z for x, z in zip(q, v)), i, y) for i, (y, v) in whole.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:n_positives]:
            fit = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:n_negatives]
            out |= {(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(fit, 1)}
    return out


def test_negatives_against_brute_force(spark, monkeypatch):
    """Many small cells and generations; clustered vectors of many lengths, ties, repeats and rows that take no part."""
    monkeypatch.setattr(negatives, "CELL_ROWS", 8)
    monkeypatch.setattr(negatives, "FANOUT", 2)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 3)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6))
    rows = []
    for i in range(700):
        v = centres[i % 4] + 0.3 * rng.normal(size=6)
        rows.append((i if i % 9 else i * 100, [float(np.float32(x)) for x in v * (1 + i % 5)], int(i % 3)))
    rows += [(5, rows[5][1], 1), (5, rows[5][1], 1), (9001, rows[4][1], 2), (9002, rows[4][1], 2), (9003, [1.0, 2.0], 0), (9100, [0.0] * 6, 1), (9200, [], 1)]
    rows += [(None, rows[1][1], 1), (9300, None, 1), (9400, [1.0, None], 1), (9500, [float("nan"), 1.0], 1), (9600, [float("inf")], 1), (9700, rows[1][1], None)]
    got = negatives.hard_negatives(vectors_of(spark, rows)).collect()
    assert {tuple(r) for r in got} == mined(rows) and len(got) == len(mined(rows)) > 500
    assert negatives.hard_negatives(vectors_of(spark, rows).limit(0)).count() == 0


def test_negatives_broadcast_no_block(spark, monkeypatch):
    """Cells meet blocks by shuffle, several shares and columns give what one gives, and nothing is broadcast."""
    for name, value in {"CELL_ROWS": 8, "FANOUT": 2, "ANCHOR_ROWS": 2, "TOGETHER": 2}.items():
        monkeypatch.setattr(negatives, name, value, raising=False)
    plans, cut = [], negatives.cut
    monkeypatch.setattr(negatives, "cut", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    rng = np.random.default_rng(29)
    rows = [(k, [float(x) for x in rng.normal(size=6) * (1 + k % 3)], k % 4) for k in range(600)]
    is_anchor = F.col("id") % 20 == 0
    got = negatives.hard_negatives(vectors_of(spark, rows), is_anchor=is_anchor).collect()
    assert plans and not any("Broadcast" in p for p in plans)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 256)
    monkeypatch.setattr(negatives, "CELL_ROWS", 1024)
    assert sorted(got) == sorted(negatives.hard_negatives(vectors_of(spark, rows), is_anchor=is_anchor).collect()) != []


def test_negatives_ranges_narrow(spark):
    """With a high score to beat only rows inside every feasible range are verified, and no due row is among the others."""
    rng = np.random.default_rng(5)
    matrix = np.floor(rng.normal(size=(1000, 8)) * 100).astype(np.int32)
    lengths = np.sqrt((matrix.astype(float) ** 2).sum(axis=1))
    unit = matrix / lengths[:, None]
    row = {"rows": 1000, "ids": np.arange(1000).tobytes(), "labels": np.zeros(1000, np.int32).tobytes(), "matrix": matrix.tobytes(), "longest": float(lengths.max()), "lists": np.ascontiguousarray(np.argsort(unit, axis=0, kind="stable").T.astype(np.int16)).tobytes()}
    cell = negatives.Cell(row)
    for q in matrix[:20].astype(np.int64):
        scores = matrix.astype(np.int64) @ q
        low = int(0.9 * lengths.max() * np.sqrt(q @ q))
        inside = cell.feasible(q, low)
        assert set(np.flatnonzero(scores >= low)) <= set(inside.tolist())
        assert len(inside) < 300
        assert len(cell.feasible(q, -5)) == 1000 and len(cell.feasible(q, int(2 * lengths.max() * np.sqrt(q @ q)))) == 0


def clustered(rows, k=16, rounds=3):
    kept = [(i, integers(v, 64)) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    cs = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cs))

    for _ in range(rounds):
        held = defaultdict(list)
        for _, v in kept:
            held[nearest(v)[1]].append(v)
        cs = [[sum(x) // len(held[n]) for x in zip(*held[n])] if n in held else c for n, c in enumerate(cs)]
    found = [(i, nearest(v)) for i, v in kept]
    sums = defaultdict(int)
    for _, (d, n) in found:
        sums[n] += d
    return sorted((-1 if i is None else i, n, d, sums[n], sum(sums.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest()) for i, (d, n) in found)


def test_centroids_against_brute_force(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(np.float32(x)) for x in np.round(rng.normal(size=64), 1)]) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(200, 230)] + [(3, rows[4][1]), (3, rows[3][1]), (None, rows[7][1]), (-8, [1e30] * 64)]  # copies: equal distances, empty centroids
    odd = [(300, None), (301, [1.0]), (302, [None] * 64), (303, [float("nan")] * 64), (304, [float("inf")] * 64)]
    given = vectors_of(spark, [(i, v, 1) for i, v in rows + odd])
    got = sorted((-1 if r.vec_id is None else r.vec_id, *r[1:]) for r in centroids.cluster_vectors(given).collect())
    reach = min(int((2**62 // 64) ** 0.5) // 2, 1 << 30)
    assert got == clustered([(i, [reach / 64] * 64 if i == -8 else v) for i, v in rows])
    assert centroids.cluster_vectors(given.limit(0)).count() == 0
    few = centroids.cluster_vectors(given.where("vec_id between 10 and 12")).collect()
    assert sorted(r.cluster for r in few) == [0, 1, 2] and all(r.distance == 0 for r in few)


def test_tree_finds_least_number(spark):
    """The tree's answer equals the scan's over many centroids with copies and vectors half-way between them."""
    rng = np.random.default_rng(2)
    cs = rng.integers(-4, 5, size=(200, 3))
    x = rng.integers(-5, 6, size=(3000, 3))
    who, far = centroids.VantageTree(cs).nearest(x)
    d = centroids.squared(x, cs)
    assert (who == d.argmin(axis=1)).all() and (far == d.min(axis=1)).all()


def test_quality_held_out(spark, sf):
    """Held-out labels of the small table are told apart well, though they were never learned."""
    folder = sf.replace("0.001", "0.01")
    scored = queries.op12_quality(spark, folder)
    held = scored.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert len(bad) >= 8 and np.mean([[a > b for b in bad] for a in good]) > 0.97
    assert np.mean([(r.predicted == 1) == (r.quality == 1) for r in held]) > 0.93
    assert all(r.predicted == (1 if r.score >= 0.7 else 0) for r in held)
    ours = {r.doc_id: r.held_out for r in scored.collect()}
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in ours.items())
    # other labels of held-out documents change nothing
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.score_quality(spark.read.parquet(f"{folder}/documents.parquet"), turned).collect()}
    assert again == {r.doc_id: r.score for r in scored.collect()}


def test_quality_odd_rows(spark):
    rows = [(1, "good words here"), (1, "good words here"), (2, None), (3, ""), (None, "junk!! junk!!"), (4, "w " * 200_000), (5, "\ud800".encode("utf-8", "replace").decode())]
    docs = spark.createDataFrame([(i, t, 1, 0.5) for i, t in rows], "doc_id long, text string, good int, score double")
    schema = "doc_id long, quality int"
    for labels in ([], [(1, 1)], [(1, 1), (1, 0), (2, None), (None, 1)], [(i, i % 2) for i in range(10)]):
        got = quality.score_quality(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
        assert {r.score for r in got if r.doc_id == 2} == {r.score for r in got if r.doc_id == 3}
        assert [r.held_out for r in got if r.doc_id is None] == [False]
        if len({y for i, y in labels if i is not None and y is not None}) < 2:
            assert len({r.score for r in got}) == 1
    assert quality.score_quality(docs.limit(0), spark.createDataFrame([], schema)).count() == 0


def test_descent_separates():
    """The dual descent reaches the margin of separable rows, and its ratios vanish for buckets never seen."""
    rng = np.random.default_rng(1)
    rows = [np.unique(np.r_[rng.integers(100, 200, 5), 1 if k % 4 else 2]).astype(np.int32) for k in range(80)]
    good = np.array([k % 4 != 0 for k in range(80)])
    y = np.where(good, 1, -1)
    ratios = quality.log_count_ratios(rows, y)
    assert ratios[1] > 0 > ratios[2] and not ratios[300:].any()
    weights, bias = quality.dual_coordinate_descent(rows, ratios, y)
    margins = np.array([weights[r].sum() / np.sqrt(len(r)) + bias for r in rows])
    assert ((margins > 0) == good).all()
    model = quality.fit_rows(rows, good)
    assert model.score(rows[1]) > 0.7 > model.score(rows[0])
