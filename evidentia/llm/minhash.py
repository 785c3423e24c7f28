"""Operator 4: near-duplicate documents by BagMinHash signatures, banding and exact multiset verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.operators.components import connected_components
from evidentia.session import cut

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 6
REGISTERS = BANDS * ROWS
#: Words hashed in one vectorised step, and words a worker remembers; both bound memory only.
STEP_WORDS, MEMO_WORDS = 400_000, 300_000
#: Members verified against one copy of a hub's shingles; a larger group is dealt over several tasks.
VERIFIED_TOGETHER = 500
#: Keys of candidate documents that may be broadcast to prune the text scan (16 bytes each); beyond it the scan is joined by shuffle.
BROADCAST_KEYS = 500_000

_U = np.uint64
_MIX = (_U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB))
_GOLD = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = (x ^ (x >> _U(30))) * _MIX[0]
    x = (x ^ (x >> _U(27))) * _MIX[1]
    return x ^ (x >> _U(31))


class Shingler:
    """Texts to multisets of hashed word shingles."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def words(self, text: str | None) -> list[str]:
        return (text or "").lower().split()

    def hashes(self, words: list[str]) -> np.ndarray:
        """One hash per shingle; a shorter text is one shingle of all its words, an empty one has none."""
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
        if not len(h):
            return h
        n = min(SHINGLE, len(h))
        out = np.full(len(h) - n + 1, n, dtype=np.uint64)
        for k in range(n):
            out = mix(out + h[k : len(h) - n + 1 + k] + _GOLD)
        return out

    def bag(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.hashes(self.words(text)), return_counts=True)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return int(np.minimum(a[1][at_a], b[1][at_b]).sum())


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Multiset overlap as a share; two empty bags are equal."""
    both = overlap(a, b)
    total = int(a[1].sum()) + int(b[1].sum()) - both
    return both / total if total else 1.0


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """BagMinHash registers of many bags at once: rows (doc, element, integer weight), one per distinct element.

    The weight axis is cut into dyadic blocks [0,1), [1,2), [2,4), ...; each (element, block) is a Poisson
    process over time with the block's length as its rate, each point falling at random on a register and
    on a place in the block. A bag sees the points below its weight, and a register keeps its earliest, so two
    bags agree on a register with probability equal to their weighted Jaccard similarity. Points come in
    order of time and a process stops at the latest register of its bag, so long bags cost about one
    point per element.
    """
    top = np.full((n_docs, REGISTERS), np.inf)
    if not len(doc):
        return top
    blocks = [(np.arange(len(doc)), np.zeros(len(doc), dtype=np.int64))]
    power = 0
    while True:
        more = np.flatnonzero(weight > 2**power)
        if not len(more):
            break
        blocks.append((more, np.full(len(more), power + 1, dtype=np.int64)))
        power += 1
    row = np.concatenate([b[0] for b in blocks])
    level = np.concatenate([b[1] for b in blocks])
    low = np.where(level == 0, 0, 2.0 ** (level - 1))
    length = np.where(level == 0, 1.0, low)
    state = mix(element[row] + level.astype(np.uint64) * _MIX[0])
    d, w = doc[row], weight[row].astype(float)
    rate, t = length * REGISTERS, np.zeros(len(row))
    flat = top.reshape(-1)
    while len(d):
        state = state + _GOLD
        u = mix(state)
        t = t - np.log1p(-((u >> _U(11)).astype(float) * 2.0**-53)) / rate
        live = t < top.max(axis=1)[d]
        if not live.all():
            d, w, low, length, rate, t, state, u = (x[live] for x in (d, w, low, length, rate, t, state, u))
        v = mix(u)
        register = ((v & _U(0xFFFFFFFF)) * _U(REGISTERS) >> _U(32)).astype(np.int64)
        inside = low + (v >> _U(32)).astype(float) * 2.0**-32 * length < w
        np.minimum.at(flat, (d * REGISTERS + register)[inside], t[inside])
    return top


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    bits = np.ascontiguousarray(registers).view(np.uint64).reshape(len(registers), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for k in range(ROWS):
        out = mix(out + bits[:, :, k] + _GOLD)
    return out.view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()

    def flush(keys: list, bags: list) -> pa.RecordBatch:
        sizes = np.array([len(b[0]) for b in bags], dtype=np.int64)
        doc = np.repeat(np.arange(len(bags)), sizes)
        element = np.concatenate([b[0] for b in bags])
        weight = np.concatenate([b[1] for b in bags])
        bands = band_keys(signatures(doc, element, weight, len(bags)))
        ends = pa.array(np.arange(0, len(bags) * BANDS + 1, BANDS), pa.int32())
        listed = pa.ListArray.from_arrays(ends, pa.array(bands.reshape(-1)))
        return pa.RecordBatch.from_arrays(
            [*(pa.array([k[i] for k in keys], pa.int64()) for i in range(4)), pa.array([int(b[1].sum()) for b in bags], pa.int64()), listed],
            ["key", "t", "d1", "d2", "n", "bands"],
        )

    keys, bags, held = [], [], 0
    for batch in batches:
        for key, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = shingler.words(text.as_py())
            digest = hashlib.blake2b("\n".join(words).encode("utf-8", "surrogatepass"), digest_size=16).digest()
            keys.append((key, t, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)))
            bags.append(np.unique(shingler.hashes(words), return_counts=True))
            held += len(words) + REGISTERS
            if held >= STEP_WORDS:
                yield flush(keys, bags)
                keys, bags, held = [], [], 0
    if keys:
        yield flush(keys, bags)


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(member, hub, both, sim): exact multiset overlap and weighted Jaccard similarity of every given pair."""
    load = pairs.groupBy("hub").agg(F.ceil(F.count("*") / VERIFIED_TOGETHER).cast("int").alias("salts"))
    members = (
        pairs.join(texts.withColumnRenamed("key", "member"), "member")
        .join(load, "hub")
        .select("hub", F.pmod(F.xxhash64("member"), F.col("salts")).cast("int").alias("salt"), "member", "text")
    )
    hubs = load.join(texts.withColumnRenamed("key", "hub"), "hub").select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("member"), "text"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, hub, bag = Shingler(), None, None
        for batch in batches:
            rows: list[list] = [[], [], [], []]
            for h, m, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if m is None:
                    hub, bag = h, shingler.bag(text.as_py())
                else:
                    own = shingler.bag(text.as_py())
                    both = overlap(own, bag)
                    total = int(own[1].sum()) + int(bag[1].sum()) - both
                    for column, value in zip(rows, (m, hub, both, both / total if total else 1.0)):
                        column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, kinds)], ["member", "hub", "both", "sim"])

    dealt = members.unionByName(hubs).repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("member").asc_nulls_first())
    return dealt.mapInArrow(compare, "member long, hub long, both long, sim double")


def _texts_of(docs: DataFrame, classes: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text) of the given class numbers, from the first row of each class; they are broadcast only when counted to be few."""
    wanted = classes.join(keys.distinct().withColumnRenamed("key", "rep"), "rep", "left_semi").select("rep", "key", "t")
    wanted = cut(wanted)
    rows = docs.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted, ["key", "t"])
    return rows.groupBy(F.col("rep").alias("key")).agg(F.min("text").alias("text"))


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            elements, weights = shingler.bag(text.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(elements), key), pa.int64()), pa.array(elements.view(np.int64)), pa.array(weights, pa.int64())], ["key", "shingle", "w"])


def _plain(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, t, text): a row is known by its key and a hash of its text, as a key may repeat with another text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).cast("long").alias("key"), F.xxhash64(body).alias("t"), body.alias("text"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, class_id, n_links): class_id is the smallest key of the document's group, n_links the verified links of its text to other texts.

    Texts equal up to case and white space form one class at once; only one of them is banded. In each bucket
    every text is verified against a hub, the text that meets most others. A text below the threshold there
    may still match another member: such pairs are compared unless a bound on their overlap rules it out, which
    adds what both share with the hub to what others share beyond it. Nothing is capped.

    Null text counts as empty, and empty texts are copies of one another. Texts under five words match equal
    texts only. Rows with a null key get a null class and take no part; repeated rows share their class. A key that
    repeats with another text has a row for each, in the class of that text. Keys are integers. Other columns are not
    read. An empty table gives an empty result.
    """
    return _classed(docs, key, text).select(F.col("key").alias(key), "class_id", "n_links")


def _classed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, t, class_id, n_links) of every row."""
    plain = _plain(docs, key, text)
    signed = cut(plain.mapInArrow(_sign, "key long, t long, d1 long, d2 long, n long, bands array<long>"))
    # classes are numbered by their text, as keys may repeat
    first = signed.where("key is not null").groupBy("d1", "d2").agg(F.min(F.struct("key", "t")).alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = cut(first.select(F.monotonically_increasing_id().alias("rep"), "first.key", "first.t", "d1", "d2", "n", "bands"))
    lone = classes.where("n > 0").select("rep", "n", "bands")
    banded = cut(lone.select("rep", "n", F.explode("bands").alias("bucket")))

    sizes = banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = banded.join(sizes, "bucket")
    degree = shared.groupBy("rep").agg(F.sum("size").alias("degree"))
    met = cut(shared.join(degree, "rep").select("bucket", "rep", "n", "degree", "size"))
    hubs = met.groupBy("bucket").agg(F.max_by("rep", F.col("degree") * 1000 + F.pmod(F.xxhash64("rep"), F.lit(1000))).alias("hub"))
    placed = met.join(hubs, "bucket").where("rep <> hub").select("bucket", F.col("rep").alias("member"), "n", "hub", "size")
    pairs = cut(placed.select("member", "hub").distinct())
    ends = pairs.select(F.col("member").alias("key")).union(pairs.select(F.col("hub").alias("key")))
    sims = cut(_verify(pairs, _texts_of(plain, classes, ends)))
    links = sims.where(F.col("sim") >= THRESHOLD).select(F.col("member").alias("src"), F.col("hub").alias("dst"))

    # Members that miss their hub may match each other, or a member that the hub holds.
    rest = placed.where("size > 2").join(sims, ["member", "hub"]).select("bucket", "member", "hub", "n", "both", "sim")
    missed = rest.where(F.col("sim") < THRESHOLD).select("bucket").distinct()
    rest = cut(rest.join(missed, "bucket"))
    if not rest.isEmpty():
        present = rest.select(F.col("member").alias("key")).union(rest.select(F.col("hub").alias("key")))
        shingles = _texts_of(plain, classes, present).mapInArrow(_shingle_rows, "key long, shingle long, w long")
        alone = shingles.groupBy("shingle").agg(F.count("*").alias("df"), F.min("key").alias("key"), F.min("w").alias("w")).where("df = 1")
        unique = alone.groupBy("key").agg(F.sum("w").alias("u")).withColumnRenamed("key", "member")
        # extra: shingles that the hub lacks and some other text here has
        bounded = rest.join(unique, "member", "left").withColumn("extra", F.col("n") - F.col("both") - F.coalesce("u", F.lit(0)))
        bounded = bounded.where(F.col("both") + F.col("extra") >= THRESHOLD * F.col("n")).join(lone.select(F.col("rep").alias("member"), "bands"), "member")
        a, b = (bounded.select("bucket", *(F.col(c).alias(f"{c}_{s}") for c in ("member", "n", "sim", "both", "extra", "bands"))) for s in "ab")
        most = F.least("both_a", "both_b") + F.least("extra_a", "extra_b")
        shared_bands = F.filter(F.arrays_zip("bands_a", "bands_b"), lambda z: z["bands_a"] == z["bands_b"])
        able = (
            (F.col("member_a") < F.col("member_b"))
            & (F.least("sim_a", "sim_b") < THRESHOLD)
            & (F.abs(F.col("sim_a") - F.col("sim_b")) <= 1 - THRESHOLD + 1e-9)  # 1 - weighted Jaccard is a metric
            & (most >= THRESHOLD * (F.col("n_a") + F.col("n_b") - most))
            & (F.col("bucket") == F.get(shared_bands, 0)["bands_a"])  # or an earlier bucket has the pair
        )
        again = a.join(b, "bucket").where(able).select(F.col("member_a").alias("member"), F.col("member_b").alias("hub")).distinct()
        again = cut(again)
        if not again.isEmpty():
            ends = again.select(F.col("member").alias("key")).union(again.select(F.col("hub").alias("key")))
            more = _verify(again, _texts_of(plain, classes, ends))
            links = links.union(more.where(F.col("sim") >= THRESHOLD).select(F.col("member").alias("src"), F.col("hub").alias("dst")))
    links = cut(links.distinct())
    groups = cut(connected_components(links).select(F.col("node").alias("rep"), "component"))
    heads = groups.join(classes.select("rep", "key"), "rep").groupBy("component").agg(F.min("key").alias("head"))
    counts = links.select(F.col("src").alias("rep")).union(links.select(F.col("dst").alias("rep"))).groupBy("rep").agg(F.count("*").alias("n_links"))
    linked = groups.join(heads, "component").join(counts, "rep").select("rep", "head", "n_links")
    named = classes.select("rep", "d1", "d2", F.col("key").alias("own")).join(linked, "rep", "left").drop("rep")
    found = signed.select("key", "t", "d1", "d2").join(named, ["d1", "d2"], "left")
    has = F.col("key").isNotNull()
    return found.select(
        "key",
        "t",
        F.when(has, F.coalesce("head", "own")).alias("class_id"),
        F.when(has, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` whose key is the smallest of their text's group; rows with a null key all stay."""
    gone = _classed(docs, key, text).where(F.col("class_id") < F.col("key")).select(F.col("key").alias("_gone_key"), F.col("t").alias("_gone_text")).distinct()
    named = docs.select(F.struct("*").alias("row"), F.col(key).cast("long").alias("_key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("_text"))
    return named.join(gone, (F.col("_key") == F.col("_gone_key")) & (F.col("_text") == F.col("_gone_text")), "left_anti").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
