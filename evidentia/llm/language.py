"""Operator 7: language identification by script ranges and Viterbi over per-word scores."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import filterfalse, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows per language that the letter model is fitted on, at most about; a fixed hash of the key picks them.
TRAIN_ROWS = 4_000
#: Nats that a change of language costs between two words.
SWITCH = 9.0
#: A language takes part in words of a script that makes up at least this share of its training letters.
SCRIPT_SHARE = 0.005
#: Weight of the shorter context, in counts.
BACKOFF = 2.0
#: Chunks and letter groups a worker remembers, the chunks between two looks at that bound, and the longest chunk remembered; they bound memory only.
MEMO_WORDS, MEMO_GRAMS, LOOK, KEPT = 100_000, 100_000, 10_000, 64
#: Letter groups whose scores are gathered at once; bounds memory only.
GATHERED = 1 << 18
#: Least share of a document's letters that its language must hold to be kept.
KEEP = 0.5

#: First code point of each script range, in order; the last range runs to the end.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "odia"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"),
    (0x1800, "mongolian"), (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3130, "hangul"), (0x3190, "kana"),
    (0x3400, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"), (0xA720, "latin"),
    (0xA800, "other"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFE70, "arabic"),
    (0xFF00, "latin"), (0xFF66, "kana"), (0xFFA0, "hangul"), (0x10000, "other"), (0x20000, "han"), (0x32000, "other"),
]
_STARTS = [start for start, _ in SCRIPTS]
_LETTERS = re.compile(r"[^\W\d_]+")
_RUNS = re.compile(r"[^\W\d_]+|\n")


def script_of(char: str) -> str:
    return SCRIPTS[bisect_right(_STARTS, ord(char)) - 1][1]


def words_of(chunk: str) -> list[str]:
    """Runs of letters; digits, fractions and other numerals are none."""
    found = _LETTERS.findall(chunk.lower())
    if chunk.isascii():
        return found
    return [word for run in found for word in ([run] if run.isalpha() else ("".join(g) for letters, g in groupby(run, str.isalpha) if letters))]


class LetterModel:
    """Letter trigrams per language with backed-off contexts, and the scripts each language uses."""

    def __init__(self, grams: list[tuple[str, str, int]]):
        self.languages = sorted({lang for lang, _, _ in grams})
        by_lang: dict[str, dict[str, Counter]] = {lang: defaultdict(Counter) for lang in self.languages}
        scripts: dict[str, Counter] = {lang: Counter() for lang in self.languages}
        for lang, gram, n in grams:
            for size in (1, 2, 3):
                by_lang[lang][gram[3 - size : 2]][gram[2]] += n
            if gram[2] != " ":
                scripts[lang][script_of(gram[2])] += n
        self.counts = by_lang
        self.totals = {lang: {ctx: sum(c.values()) for ctx, c in table.items()} for lang, table in by_lang.items()}
        self.alphabet = max(1, len({gram[2] for _, gram, _ in grams}))
        self.users: dict[str, set[int]] = defaultdict(set)
        for k, lang in enumerate(self.languages):
            letters = sum(scripts[lang].values())
            for script, n in scripts[lang].items():
                if n >= SCRIPT_SHARE * letters:
                    self.users[script].add(k)
        self.memo: dict[str, tuple[float, ...]] = {}
        #: By script range: the languages that take part in its words; all of them where no language uses it.
        self.takes = np.array([[k in self.users[name] for k in range(len(self.languages))] if self.users.get(name) else [True] * len(self.languages) for _, name in SCRIPTS], dtype=bool)
        self._forget()

    def _forget(self) -> None:
        self.known, self.rows = np.zeros(0, dtype=np.int64), np.zeros((0, len(self.languages)))

    def _gram(self, gram: str) -> tuple[float, ...]:
        got = self.memo.get(gram)
        if got is None:
            row = []
            for lang in self.languages:
                p = 1.0 / (self.alphabet + 1)
                for size in (1, 2, 3):
                    context = gram[3 - size : 2]
                    total = self.totals[lang].get(context, 0)
                    p = (self.counts[lang][context][gram[2]] + BACKOFF * p) / (total + BACKOFF) if total else p
                row.append(math.log(p))
            if len(self.memo) >= MEMO_GRAMS:
                self.memo.clear()
            self.memo[gram] = got = tuple(row)
        return got

    def score(self, word: str) -> list[float]:
        padded = f"  {word} "
        sums = [sum(column) for column in zip(*(self._gram(padded[i : i + 3]) for i in range(len(padded) - 2)))]
        users = self.users.get(script_of(word[0]))
        if users:  # a script that no language uses narrows nothing
            floor = min(sums) - 2 * SWITCH
            sums = [s if k in users else floor for k, s in enumerate(sums)]
        return sums

    def _rows(self, keys: np.ndarray) -> np.ndarray:
        """The scores of letter groups, each three code points in one number; new groups are added to the sorted table."""
        at = np.searchsorted(self.known, keys)
        new = np.ones(len(keys), dtype=bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != keys[inside]
        if new.any():
            fresh = np.unique(keys[new])
            if len(self.known) + len(fresh) > MEMO_GRAMS:
                self._forget()
                fresh = np.unique(keys)
            rows = np.array([self._gram("".join(chr(key >> shift & 0x1FFFFF) for shift in (42, 21, 0))) for key in fresh.tolist()])
            order = np.argsort(known := np.concatenate([self.known, fresh]), kind="stable")
            self.known, self.rows = known[order], np.concatenate([self.rows, rows])[order]
            at = np.searchsorted(self.known, keys)
        return self.rows[at]

    def score_all(self, words: list[str]) -> np.ndarray:
        """The same as `score` for many words at once, a row each."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 3
        starts = np.cumsum(sizes) - sizes
        codes = np.frombuffer(("  " + "   ".join(words) + " ").encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        sums = np.zeros((len(words), len(self.languages)))
        opens = np.ones(len(codes), dtype=bool)  # a group opens anywhere but at a padded word's last two places
        opens[starts + sizes - 1] = opens[starts + sizes - 2] = False
        for at in range(0, len(codes) - 2, GATHERED):
            part = codes[at : at + GATHERED + 2]
            here = np.flatnonzero(opens[at : at + len(part) - 2])
            if not len(here):
                continue
            rows = self._rows(part[here] << 42 | part[here + 1] << 21 | part[here + 2])
            word = np.searchsorted(starts, here + at, "right") - 1
            first = np.flatnonzero(np.diff(word, prepend=-1))
            sums[word[first]] += np.add.reduceat(rows, first)
        takes = self.takes[np.searchsorted(_STARTS, codes[starts + 2], "right") - 1]
        return np.where(takes, sums, sums.min(axis=1, keepdims=True) - 2 * SWITCH)


class Labeller(dict):
    """chunk -> (best language, scores, letters), or None without letters."""

    def __init__(self, model: LetterModel):
        self.model = model

    def learn(self, chunks: list[str]) -> None:
        """Score all words of new chunks together."""
        runs = _RUNS.findall("\n".join(chunks).lower() + "\n")
        words: list[str] = []
        ends = []
        for run in runs:
            if run == "\n":
                ends.append(len(words))
            elif run.isalpha():
                words.append(run)
            else:
                words += words_of(run)
        self.update(dict.fromkeys(chunks))
        if not words:
            return
        ends_ = np.array(ends)
        starts = np.concatenate([[0], ends_[:-1]])
        some = np.flatnonzero(ends_ > starts)
        sums = np.add.reduceat(self.model.score_all(words), starts[some])
        letters = np.add.reduceat(np.fromiter(map(len, words), dtype=np.int64, count=len(words)), starts[some])
        self.update(zip(map(chunks.__getitem__, some.tolist()), zip(sums.argmax(axis=1).tolist(), map(tuple, sums.tolist()), letters.tolist())))

    def label(self, chunks: list[str]) -> tuple[list, list[int]]:
        """Items with letters and each one's language on the best path."""
        items: list = []
        for at in range(0, len(chunks), LOOK):  # the bound holds within a long text too
            if len(self) > MEMO_WORDS:
                self.clear()
            part = chunks[at : at + LOOK]
            new = list(filterfalse(self.__contains__, set(part)))
            if new:
                self.learn(new)
            items += filter(None, map(self.__getitem__, part))
            for chunk in new:
                if len(chunk) > KEPT:
                    del self[chunk]
        return items, best_path(items, len(self.model.languages))


def best_path(items: list, n_langs: int, switch: float = SWITCH) -> list[int]:
    """Viterbi over (best, scores, ...) items with a penalty for each change; ties stay, then go to the first language.

    While one language leads by the whole penalty and wins every word, the path cannot leave it: those words
    are passed over, and only stretches around other words keep back pointers.
    """
    n = len(items)
    out = [0] * n
    if not n:
        return out
    langs = range(n_langs)
    v, begin, back = list(items[0][1]), 0, []
    fixed, lead, last = False, 0, None
    for i in range(1, n):
        best, s = items[i][0], items[i][1]
        if fixed:
            if best == lead:
                last = s
                continue
            base = last[lead] + switch
            v = [x - base for x in last]
            v[lead] = 0.0
            out[begin : i - 1] = [lead] * (i - 1 - begin)
            begin, back, fixed = i - 1, [], False
        top = max(v)
        at = v.index(top)
        least = top - switch
        came = [k if v[k] >= least else at for k in langs]
        v = [s[k] + (v[k] if v[k] >= least else least) - top for k in langs]
        back.append(came)
        if came.count(at) == n_langs:
            k = at
            for j in range(i - 1, begin - 1, -1):
                out[j] = k
                if j > begin:
                    k = back[j - begin - 1][k]
            begin, back = i, []
            if best == at:
                fixed, lead, last = True, at, s
    if fixed:
        out[begin:n] = [lead] * (n - begin)
        return out
    k = v.index(max(v))
    for j in range(n - 1, begin - 1, -1):
        out[j] = k
        if j > begin:
            k = back[j - begin - 1][k]
    return out


def verdict(labeller: Labeller, text: str | None) -> tuple[str, float, list[int]]:
    """The language with most letters on the best path, its share of all letters, and the path."""
    languages = labeller.model.languages
    items, path = labeller.label(text.split()) if languages and text else ([], [])
    letters = [0] * len(languages)
    for item, k in zip(items, path):
        letters[k] += item[2]
    most = max(letters, default=0)
    return (languages[letters.index(most)], most / sum(letters), path) if most else ("und", 0.0, path)


def _crc(key: str):
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", modulus: int = 5, rows_per_language: int = TRAIN_ROWS) -> LetterModel:
    """Fit letter trigrams on the labelled rows outside the held-out fold.

    At most about `rows_per_language` rows of each language are read, picked by a fixed hash of the key; their
    trigram counts, which the sample bounds, are what reaches the driver.
    """
    labelled = docs.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.pmod(_crc(key), F.lit(modulus)) != 0))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return LetterModel([])
    share = F.create_map(*(F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, rows_per_language / n))))
    chance = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("language")), F.lit(1_000_000)) / 1_000_000
    sample = labelled.where(chance < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                for chunk, n in Counter(value.as_py().split()).items():
                    for word in words_of(chunk):
                        padded = f"  {word} "
                        for i in range(len(padded) - 2):
                            seen[name][padded[i : i + 3]] += n
        rows = [(name, gram, n) for name, grams in seen.items() for gram, n in grams.items()]
        names = ["lang", "gram", "n"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], names)

    grams = sample.mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return LetterModel([(r["lang"], r["gram"], r["n"]) for r in grams.collect()])


def identify(docs: DataFrame, model: LetterModel, key: str = "doc_id", text: str = "text", spans: bool = False) -> DataFrame:
    """(key, lang_pred, score[, spans]), one row per input row.

    lang_pred is the language with most letters on the best path, ties to the first by name, and score its
    share of all letters. Null texts and texts without a letter give `und` and 0, as does a model without
    languages. spans lists runs of words as (first, end, lang). Other columns are not read.
    """
    languages = model.languages
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(shared.value)
        for batch in batches:
            preds, scores, runs = [], [], []
            for value in batch.column(1):
                pred, score, path = verdict(labeller, value.as_py())
                preds.append(pred)
                scores.append(score)
                if spans:
                    cuts = [i for i in range(len(path)) if i == 0 or path[i] != path[i - 1]]
                    runs.append([{"first": a, "end": b, "lang": languages[path[a]]} for a, b in zip(cuts, [*cuts[1:], len(path)])])
            columns = [batch.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())]
            if spans:
                columns.append(pa.array(runs, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
            yield pa.RecordBatch.from_arrays(columns, ["key", "lang_pred", "score"] + ["spans"] * spans)

    plain = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = plain.schema["key"].dataType.simpleString()
    schema = f"key {kind}, lang_pred string, score double" + ", spans array<struct<first:long,end:long,lang:string>>" * spans
    return plain.mapInArrow(run, schema).withColumnRenamed("key", key)


def keep_identified(docs: DataFrame, model: LetterModel, text: str = "text", least: float = KEEP) -> DataFrame:
    """The rows whose predicted language holds at least `least` of their letters; all columns pass through unchanged and nothing is shuffled.

    Null texts, texts without a letter, and texts in which no language holds so much go. A model without languages
    rejects only what has no letter. Only the text passes through Python.
    """
    if not model.languages:
        return docs.where(F.col(text).rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        labeller = Labeller(shared.value)
        for batch in batches:
            yield pd.Series([verdict(labeller, value)[1] for value in batch], dtype="float64")

    return docs.where(score(F.col(text)) >= least)


def predict(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Fit outside the held-out fold (crc32 of the key's text mod 5 is 0) and label every row."""
    found = identify(docs, fit(docs, key, text, lang), key, text)
    return found.select(key, (F.pmod(_crc(key), F.lit(5)) == 0).alias("held_out"), "lang_pred", "score")
