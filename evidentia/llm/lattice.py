"""Operator 10: language-model scores as marginal likelihoods over all subword segmentations."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from copy import copy

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.frequent import commonest
from evidentia.session import stored

#: Commonest words whose scores every worker holds; the scores of all others are joined by shuffle.
COMMON_WORDS = 100_000
#: Expectation-maximisation runs over all distinct training words until a round raises their mean log10 probability a token by less than this.
GAIN = 0.005
#: Rounds over one WARM_SHARE-th of the words that only give the whole rounds their start; it is a share of the words at every size.
WARM_ROUNDS, WARM_SHARE = 5, 8
#: Added to every piece's expected count, so that no piece or byte is impossible.
SMOOTH = 0.1
#: Distinct words counted before a worker hands on what it has; bounds memory only.
HELD_WORDS = 400_000
#: Words scored together and letters of one length at once: many share the cost of a numpy call; both bound memory only.
TOGETHER, LETTERS = 50_000, 200_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MARK = 0x2581  # the sign that opens a word
_TOP = np.uint64(48)  # the first 16 bits of a hash


class PieceModel:
    """A unigram distribution over an existing vocabulary's pieces; scores are natural logarithms."""

    def __init__(self, pieces: list[str], byte_ids: list[int], logp: np.ndarray):
        self.logp, self.byte_ids = logp, np.array(byte_ids)
        self.longest = max(map(len, pieces), default=1)
        spelt = set(byte_ids)
        own: dict[int, list[tuple[int, int]]] = {}
        for i, p in enumerate(pieces):
            if p and i not in spelt:
                own.setdefault(len(p), []).append((self._hash(p), i))
        #: By length: sorted hashes, ids and letters of the pieces.
        self.by_length = {}
        for size, found in sorted(own.items()):
            found.sort()
            letters = np.array([[ord(c) for c in pieces[i]] for _, i in found], dtype=np.uint32)
            self.by_length[size] = (np.array([h for h, _ in found], dtype=np.uint64), np.array([i for _, i in found], dtype=np.int64), letters)
        #: By length: which first bits of a hash any piece has.
        self.opening = {size: np.isin(np.arange(1 << 16, dtype=np.uint64), hashes >> _TOP) for size, (hashes, _, _) in self.by_length.items()}

    def weighted(self, logp: np.ndarray) -> PieceModel:
        """The same pieces with other scores."""
        other = copy(self)
        other.logp = logp
        return other

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) % 2**64
        return h

    def _edges(self, codes: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, piece ids) over words of one length, in order of end. A character that is no piece is spelt by its bytes.

        Hashes find a piece, its letters confirm it.
        """
        n, length = codes.shape
        across = np.ascontiguousarray(codes.T)  # a row for each place, so that all words are one long run
        prefix = np.zeros((length + 1, n), dtype=np.uint64)
        for i in range(length):
            prefix[i + 1] = prefix[i] * _BASE + across[i].astype(np.uint64) + np.uint64(1)
        flat = across.ravel()
        found: list[list[np.ndarray]] = [[], [], [], []]  # end, size, row and piece of every hit; no piece is -1
        spelt = np.ones(length * n, dtype=bool)
        for size, (hashes, ids, letters) in self.by_length.items():
            if size > length:
                break
            h = (prefix[size:] - prefix[: length + 1 - size] * np.uint64(pow(int(_BASE), size, 2**64))).ravel()
            places = np.flatnonzero(self.opening[size].take((h >> _TOP).view(np.int64)))  # most places are no piece and go here
            h = h[places]
            at = np.searchsorted(hashes, h)
            at[at == len(hashes)] = 0
            same = hashes[at] == h
            places, at = places[same], at[same]
            right = np.ones(len(places), dtype=bool)
            for i in range(size):
                right &= letters[at, i] == flat[places + i * n]
            places, at = places[right], at[right]
            if size == 1:
                spelt[places] = False
            starts = places // n
            for column, values in zip(found, (starts + size, np.full(len(places), size), places - starts * n, ids[at])):
                column.append(values)
        places = np.flatnonzero(spelt)
        starts = places // n
        for column, values in zip(found, (starts + 1, np.zeros(len(places), dtype=np.int64), places - starts * n, np.full(len(places), -1))):
            column.append(values)
        ends, sizes, rows, ids = map(np.concatenate, found)
        kind = ends * (self.longest + 1) + sizes
        if (length + 1) * (self.longest + 1) < 1 << 16:
            kind = kind.astype(np.uint16)  # sorted by radix
        order = np.argsort(kind, kind="stable")
        kind, rows, ids = kind[order], rows[order], ids[order]
        cuts = [0, *(np.flatnonzero(kind[1:] != kind[:-1]) + 1).tolist(), len(kind)]
        out = []
        for x, y in zip(cuts, cuts[1:]):
            end, size = divmod(int(kind[x]), self.longest + 1)
            out.append((end - max(size, 1), end, rows[x:y], ids[x:y] if size else None))
        return out

    def _byte_score(self, codes: np.ndarray) -> np.ndarray:
        return np.array([self.logp[self.byte_ids[list(chr(c).encode("utf-8", "replace"))]].sum() for c in codes.tolist()])

    def score(self, words: list[str], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log probabilities of words; with weights, also the weighted expected count of every piece."""
        out = np.zeros(len(words))
        expected = None if weights is None else np.zeros(len(self.logp))
        lengths = np.array([len(w) for w in words])
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order])) + 1
        for group in np.split(order, cuts):
            step = max(1, LETTERS // (int(lengths[group[0]]) + 1) if len(group) else 1)
            for at in range(0, len(group), step):
                rows = group[at : at + step]
                text = "".join(words[i] for i in rows)
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(rows), -1)
                codes = np.concatenate([np.full((len(rows), 1), _MARK, dtype=np.uint32), codes], axis=1)
                out[rows] = self._forward(codes, None if weights is None else weights[rows], expected)
        return out, expected

    def _forward(self, codes: np.ndarray, weights: np.ndarray | None, expected: np.ndarray | None) -> np.ndarray:
        n, length = codes.shape
        edges = self._edges(codes)
        priced = [self.logp[ids] if ids is not None else self._byte_score(codes[rows, start]) for start, _, rows, ids in edges]
        alpha = np.full((length + 1, n), -np.inf)
        alpha[0] = 0.0
        for (start, end, rows, _), price in zip(edges, priced):
            here = alpha[end]
            here[rows] = np.logaddexp(here[rows], alpha[start][rows] + price)
        if weights is not None:
            pieces, shares = [], []
            beta = np.full((length + 1, n), -np.inf)
            beta[length] = 0.0
            for (start, end, rows, ids), price in zip(reversed(edges), reversed(priced)):
                through = beta[end][rows] + price
                here = beta[start]
                here[rows] = np.logaddexp(here[rows], through)
                share = np.exp(alpha[start][rows] + through - alpha[length][rows]) * weights[rows]
                if ids is not None:
                    pieces.append(ids)
                    shares.append(share)
                else:
                    for c, s in zip(codes[rows, start].tolist(), share.tolist()):
                        np.add.at(expected, self.byte_ids[list(chr(c).encode("utf-8", "replace"))], s)
            if pieces:
                expected += np.bincount(np.concatenate(pieces), weights=np.concatenate(shares), minlength=len(expected))
        return alpha[length]


def read_vocabulary(path: str) -> tuple[list[str], list[int], np.ndarray]:
    """Pieces, the ids of the 256 byte pieces, and starting weights from the vocabulary's own scores.

    A merge vocabulary scores its pieces by rank only, so the k-th best starts at a share of 1/(k+1).
    """
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    pieces = [sp.id_to_piece(i) if not (sp.is_control(i) or sp.is_unknown(i)) else "" for i in range(n)]
    byte_ids = sorted((i for i in range(n) if sp.is_byte(i)), key=lambda i: int(pieces[i][3:5], 16))
    scores = np.array([sp.get_score(i) for i in range(n)])
    rank = np.empty(n)
    rank[np.argsort(-scores, kind="stable")] = np.arange(n)
    start = 1.0 / (rank + 2)
    start[[i for i, p in enumerate(pieces) if not p]] = 0.0
    return pieces, byte_ids, start


def _tokens(raw: bytes) -> list[bytes]:
    return raw.lower().split()  # on bytes both mean ASCII alone


def count_words(keyed: DataFrame) -> DataFrame:
    """(word, c, n): every word's count in training rows and in all rows, from (key, text, train)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bool, Counter] = {True: Counter(), False: Counter()}

        def flush() -> pa.RecordBatch:
            words = list(seen[True].keys() | seen[False].keys())
            c = [seen[True][w] for w in words]
            n = [x + seen[False][w] for x, w in zip(c, words)]
            for counter in seen.values():
                counter.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(c, pa.int64()), pa.array(n, pa.int64())], ["word", "c", "n"])

        for batch in batches:
            for raw, train in zip(batch.column(0).cast(pa.binary()), batch.column(1).to_pylist()):
                seen[train].update(_tokens(raw.as_py()))
                if len(seen[True]) + len(seen[False]) > HELD_WORDS:
                    yield flush()
        yield flush()

    rows = keyed.select("text", "train").mapInArrow(count, "word binary, c long, n long")
    return rows.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


def _together(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most`."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= most:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _text(word: bytes) -> str:
    return word.decode("utf-8", "replace")


def fit(words: DataFrame, vocabulary_path: str, train_docs: int, gain: float = GAIN) -> tuple[list[str], list[int], np.ndarray, float]:
    """Piece log probabilities and the end's, by expectation-maximisation until a round over all distinct training words gains less than `gain`.

    Only the expected counts, one per piece, and the likelihood reach the driver.
    """
    pieces, byte_ids, start = read_vocabulary(vocabulary_path)
    usable = start > 0
    spark = words.sparkSession
    shape = spark.sparkContext.broadcast(PieceModel(pieces, byte_ids, start))  # a worker keeps it over all rounds
    train = words.where("c > 0").select("word", "c")
    warm = train.where(F.pmod(F.xxhash64("word"), F.lit(WARM_SHARE)) == 0)

    def normal(counts: np.ndarray, end: float) -> tuple[np.ndarray, float]:
        total = counts[usable].sum() + end
        with np.errstate(divide="ignore"):
            return np.where(usable, np.log(np.where(usable, counts, 1.0) / total), -np.inf), math.log(end / total)

    def expected(rows: DataFrame, logp: np.ndarray) -> tuple[np.ndarray, float, float]:
        """Expected count of every piece, tokens and their log probability."""
        shared = spark.sparkContext.broadcast(logp)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shape.value.weighted(shared.value)
            total, tokens, likelihood = np.zeros(len(model.logp)), 0.0, 0.0
            for batch in _together(batches, TOGETHER):
                c = batch.column(1).to_numpy().astype(float)
                lp, got = model.score([_text(w) for w in batch.column(0).to_pylist()], c)
                total += got
                tokens += c.sum()
                likelihood += (lp * c).sum()
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *at.tolist()], pa.int64()), pa.array([tokens, likelihood, *total[at].tolist()], pa.float64())], ["piece", "e"])

        got = {r["piece"]: r["e"] for r in rows.mapInArrow(expect, "piece long, e double").groupBy("piece").agg(F.sum("e").alias("e")).collect()}
        tokens, likelihood = got.pop(-2, 0.0), got.pop(-1, 0.0)
        counts = np.full(len(pieces), SMOOTH)
        counts[list(got.keys())] += list(got.values())
        return counts, tokens, likelihood

    logp, end = normal(start, start.sum() * 0.002)
    for _ in range(WARM_ROUNDS):
        counts, tokens, _ = expected(warm, logp)
        if not tokens:
            break
        logp, end = normal(counts, max(train_docs / WARM_SHARE, SMOOTH))
    before = -math.inf
    while True:
        counts, tokens, likelihood = expected(train, logp)
        now = (likelihood + train_docs * end) / (tokens + train_docs) / math.log(10) if tokens + train_docs else 0.0
        logp, end = normal(counts, train_docs + SMOOTH)
        if not now - before >= gain or not tokens:
            return pieces, byte_ids, logp, end
        before = now


def score_documents(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", held: int = 2, modulus: int = 7) -> DataFrame:
    """Base and lattice scores of every document, as log10 probabilities; one row per input row.

    Training rows are those whose crc32(key as text) mod `modulus` is not `held`; a null key counts as an
    empty text there. Words are runs outside ASCII white space with A-Z lowered, then one end. Null text is an
    empty document, which has the end alone. Repeated rows keep their rows; other columns are not read; an
    empty table gives an empty result, and without training rows the counts are zero.
    """
    spark = docs.sparkSession
    crc = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    whole = F.coalesce(F.col(text), F.lit(""))
    row = [F.xxhash64(F.col(key), F.col(key).isNull(), whole).alias("r1"), F.xxhash64(whole, F.col(key).isNull(), F.col(key), F.lit(1)).alias("r2")]
    keyed = docs.select(*row, F.col(key).alias("key"), whole.alias("text"), (F.pmod(crc, F.lit(modulus)) != held).alias("train"))
    words = stored(count_words(keyed), "words")
    sums = words.agg(F.sum("c").alias("tokens"), F.count_if(F.col("c") > 0).alias("distinct")).first()
    train_docs = keyed.where("train").count()
    total = (sums["tokens"] or 0) + train_docs
    kinds = (sums["distinct"] or 0) + (train_docs > 0)
    pieces, byte_ids, logp, end = fit(words, vocabulary_path, train_docs)
    shared = spark.sparkContext.broadcast(PieceModel(pieces, byte_ids, logp))

    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in _together(batches, TOGETHER):
            got, _ = model.score([_text(w) for w in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got / math.log(10))], ["word", "c", "n", "lp"])

    priced = stored(words.mapInArrow(price, "word binary, c long, n long, lp double"), "priced")
    common = spark.sparkContext.broadcast({bytes(r["word"]): (r["c"], math.log10(r["c"] + 1), r["lp"]) for r in commonest(priced, COMMON_WORDS).collect()})

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = common.value
        names = ["r1", "r2", "key", "word", "n", "rows", "tokens", "known", "base", "lp"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words_: list[bytes] = []
                counts: list[int] = []
                ends, sums = [0], []
                for raw in part.column(3).cast(pa.binary()):
                    tokens = _tokens(raw.as_py())
                    base, lp, in_train = 0.0, 0.0, 0
                    for word, n in Counter(tokens).items():
                        got = known.get(word)
                        if got is None:
                            words_.append(word)
                            counts.append(n)
                        else:
                            base += n * got[1]
                            lp += n * got[2]
                            if got[0]:
                                in_train += n
                    ends.append(len(words_))
                    sums.append((1, len(tokens), in_train, base, lp))
                # a row for each rare word, then one row of sums for each document; its word holds a blank, as no token does, and so meets no other
                docs_ = np.arange(part.num_rows)
                owner = pa.array(np.concatenate([np.repeat(docs_, np.diff(ends)), docs_]))
                marks = [b" %d" % r for r in part.column(0).to_pylist()]
                columns = [part.column(x).take(owner) for x in range(3)] + [pa.array(words_ + marks, pa.binary()), pa.array(counts + [0] * len(marks), pa.int64())]
                for values, kind_ in zip(zip(*sums), (np.int64, np.int64, np.int64, float, float)):
                    columns.append(pa.array(np.concatenate([np.zeros(len(words_), dtype=kind_), np.array(values, dtype=kind_)])))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = keyed.schema["key"].dataType.simpleString()
    gathered = keyed.select("r1", "r2", "key", "text").mapInArrow(gather, f"r1 long, r2 long, key {kind}, word binary, n long, rows long, tokens long, known long, base double, lp double")
    rest = priced.select(F.col("word").alias("w"), F.col("c"), F.log10(F.col("c") + 1).alias("w_base"), F.col("lp").alias("w_lp"))
    joined = gathered.join(rest, F.col("word") == F.col("w"), "left")
    zero = F.lit(0)
    sums_ = joined.groupBy("r1", "r2", "key").agg(
        F.sum("rows").alias("rows"),
        F.sum("tokens").alias("tokens"),
        F.sum(F.col("known") + F.when(F.col("c") > 0, F.col("n")).otherwise(zero)).alias("known"),
        F.sum(F.col("base") + F.coalesce(F.col("n") * F.col("w_base"), zero)).alias("base"),
        F.sum(F.col("lp") + F.coalesce(F.col("n") * F.col("w_lp"), zero)).alias("lp"),
    )
    # rows that repeat key and text were summed together; each gets its share
    share = [F.expr("tokens div rows").alias("tokens"), F.expr("known div rows").alias("known"), (F.col("base") / F.col("rows")).alias("base"), (F.col("lp") / F.col("rows")).alias("lp")]
    sums_ = sums_.select("key", *share, F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy"))
    n_tokens = F.col("tokens") + 1
    rid_crc = F.crc32(F.coalesce(F.col("key").cast("string"), F.lit("")).cast("binary"))
    return sums_.select(
        F.col("key").alias(key),
        (F.pmod(rid_crc, F.lit(modulus)) == held).alias("held_out"),
        n_tokens.alias("n_tokens"),
        (F.col("known") + int(train_docs > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(train_docs + 1) - n_tokens * math.log10(total + kinds + 1)).alias("base_score"),
        (F.col("lp") + end / math.log(10)).alias("score"),
    )
