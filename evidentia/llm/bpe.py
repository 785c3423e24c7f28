"""Operator 5: BPE encoding and decoding over a memory-mapped lexicon of frequent words."""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.frequent import commonest
from evidentia.llm.lexicon import Lexicon, compile_lexicon
from evidentia.llm.words import WordVocabulary, chunks, vocabulary
from evidentia.session import stored

#: Words in the lexicon; the rest are merged when they are met.
LEXICON_WORDS = 65_536
#: Chunks and words that a worker remembers before it starts afresh, and the longest that it keeps; bounds memory, never results.
MEMO_CHUNKS, MEMO_WORDS, KEPT = 200_000, 400_000, 64
#: Distinct chunks counted before a worker hands on what it has.
COUNTED = 100_000
#: Characters of documents whose new words are looked up and merged together.
TOGETHER = 2_000_000


class Memo:
    """chunk -> little-endian ids and, if asked for, their decoded string; words come from the lexicon, or from exact merges."""

    def __init__(self, vocabulary: WordVocabulary, lexicon: Lexicon | None = None, decoded: bool = False):
        self.vocabulary, self.lexicon, self.decoded = vocabulary, lexicon, decoded
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.words: dict[str, bytes] = {}
        self.long: list[str] = []

    def learn(self, chunks_: set[str]) -> None:
        """Look up all the new chunks' words in one walk of the lexicon and merge the others."""
        new = list(chunks_.difference(self.ids))
        if len(self.ids) + len(new) > MEMO_CHUNKS:
            self.ids.clear()
            self.texts.clear()
            new = list(chunks_)
        if len(self.words) > MEMO_WORDS or not self.words:
            self.words = {w: i.to_bytes(4, "little") for w, i in self.vocabulary.special.items()} | {"\n": b""}
        self.long += [c for c in new if len(c) > KEPT]
        pieces = self.vocabulary.pieces_together(new)
        words = list(set(pieces).difference(self.words))
        if self.lexicon and words:
            for word, number in zip(words, self.lexicon.numbers(words).tolist()):
                if number >= 0:
                    self.words[word] = self.lexicon.ids(number).tobytes()
            words = [w for w in words if w not in self.words]
        self.words.update(zip(words, self.vocabulary.merge_many(words)))
        # a line feed has no ids; any other piece has some
        raw = list(map(self.words.__getitem__, pieces))
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        ends = np.append(np.cumsum(sizes)[sizes == 0], sizes.sum()).tolist()
        flat = b"".join(raw)
        own = [flat[a:b] for a, b in zip(ends, ends[1:])]
        self.ids.update(zip(new, own))
        if self.decoded:
            tokens = self.vocabulary.tokens
            self.texts.update(zip(new, (" ".join([tokens[i] for i in memoryview(r).cast("I")]) for r in own)))

    def shed(self) -> None:
        """Forget what is too long to be kept, once its document is done."""
        for chunk in self.long:
            self.ids.pop(chunk, None)
            self.texts.pop(chunk, None)
            for word in self.vocabulary.pieces(chunk):
                if len(word) > KEPT:
                    self.words.pop(word, None)
        self.long = []


@lru_cache(maxsize=1)
def memo_of(tokenizer_path: str, lexicon_path: str | None = None, decoded: bool = False) -> Memo:
    """The worker's memory of chunks; tasks that follow one another in a worker share it."""
    return Memo(vocabulary(tokenizer_path), Lexicon(lexicon_path) if lexicon_path else None, decoded)


def portions(batch: pa.RecordBatch, column: int = 1, together: int = TOGETHER) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    """Slices of a batch of about `together` characters, and their texts' chunks."""
    split: list[list[str]] = []
    first, size = 0, 0
    for k, value in enumerate(batch.column(column)):
        text = value.as_py()
        split.append(chunks(text))
        size += len(text)
        if size >= together:
            yield batch.slice(first, k + 1 - first), split
            split, first, size = [], k + 1, 0
    if split:
        yield batch.slice(first), split


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def frequent_words(docs: DataFrame, tokenizer_path: str, text: str = "text", limit: int = LEXICON_WORDS) -> list[str]:
    """The commonest words of the whole corpus, at most `limit` of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def flush() -> pa.RecordBatch:
            words, counts, n = Counter(), iter(seen.values()), 0
            for word in vocabulary(tokenizer_path).pieces_together(list(seen)):
                if word == "\n":
                    n = next(counts)
                else:
                    words[word] += n
            out = pa.RecordBatch.from_arrays([pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for value in batch.column(0):
                seen.update(chunks(value.as_py()))
                if len(seen) > COUNTED:
                    yield flush()
        yield flush()

    texts = _keyed(docs, text, text).select("text")
    counts = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return [r["word"] for r in commonest(stored(counts, "word-counts"), limit).collect()]


#: Lexicons that an application's executors already have, by content.
_published: set[tuple[str, str]] = set()


def publish_lexicon(spark, words: list[str], tokenizer_path: str) -> str:
    """Compile the words, hand the file to every executor, and return its name there."""
    known = vocabulary(tokenizer_path)
    plain = [w for w in words if w not in known.special]
    data = compile_lexicon((w, memoryview(raw).cast("I").tolist()) for w, raw in zip(plain, known.merge_many(plain)))
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    if (here := (spark.sparkContext.applicationId, name)) in _published:
        return name
    path = os.path.join(tempfile.mkdtemp(prefix="lexicon-"), name)
    with open(path, "wb") as f:
        f.write(data)
    spark.sparkContext.addFile(path)  # the driver serves it; each executor keeps its own copy
    _published.add(here)
    return name


def encode(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", lexicon_words: int = LEXICON_WORDS, decoded: bool = False) -> DataFrame:
    """(key, n_tokens, ids[, decoded]) with ids as little-endian unsigned 32-bit integers, one row per input row.

    Null text counts as empty and gives no ids; repeated rows and null keys keep their rows; other columns
    are not read; an empty table gives an empty result. Special strings inside texts become their ids.
    With `decoded` the ids are turned back into text in the same pass, as `decode` does: a text's ids are its
    chunks' ids in order, so its decoded text is that of each chunk's ids, joined by blanks.
    """
    name = publish_lexicon(docs.sparkSession, frequent_words(docs, tokenizer_path, text, lexicon_words), tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = memo_of(tokenizer_path, SparkFiles.get(name), decoded)
        for batch in batches:
            for part, split in portions(batch):
                memo.learn(set().union(*split))
                ids = [b"".join(map(memo.ids.__getitem__, c)) for c in split]
                texts = [" ".join(map(memo.texts.__getitem__, c)) for c in split] if decoded else []
                memo.shed()
                columns = [part.column(0), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decoded:
                    columns.append(pa.array(texts, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, ["key", "n_tokens", "ids", "decoded"][: len(columns)])

    plain = _keyed(docs, key, text)
    kind = plain.schema["key"].dataType.simpleString()
    return plain.mapInArrow(run, f"key {kind}, n_tokens long, ids binary" + ", decoded string" * decoded).withColumnRenamed("key", key)


def decode(encoded: DataFrame, tokenizer_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the decoded text: the ids' token strings joined by single blanks, special tokens kept."""
    kept = [c for c in encoded.columns if c != out]
    inner = encoded.select(*kept)
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        tokens = vocabulary(tokenizer_path).tokens
        for batch in batches:
            texts = [" ".join(map(tokens.__getitem__, np.frombuffer(raw or b"", dtype="<u4").tolist())) for raw in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*kept, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields) + f", `{out}` string"
    return inner.mapInArrow(run, schema)
