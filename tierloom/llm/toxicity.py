"""Toxicity by noisy-channel deobfuscation: Viterbi over character lattices, then a score of the restored text.

1. A character trigram model is counted over all documents.
2. Disguised words (digits or signs for letters, letters repeated three times or more, signs strewn in, letters spaced
   out) become lattices of readings; Viterbi takes the reading the model and the channel costs together like best.
   A word without such marks has one reading, itself. Signs at the end are letters or punctuation, digits and signs
   alone are letters or no word.
3. A logistic model over words and word beginnings of the restored text gives the score. It is fitted on labelled
   training rows, at most `sample_rows` of them (all, if there are fewer).

Cases: null, empty and wordless texts get the score of a text without features; texts are read whole; repeated rows
get equal scores; without labelled rows of both kinds every score is 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import (
    BoundedCache,
    column_of,
    map_texts,
    named_again,
    neutral,
    text_chunks,
    texts_of,
    white_space_tokens,
)
from tierloom.sources.staging import stage

# The letters that a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Log-probabilities of the channel: a sign for a letter, a sign strewn in, a letter repeated, a gap put in, a gap meant.
SUBSTITUTED, STREWN, REPEATED, GAP_ADDED, GAP_MEANT = -1.0, -1.5, -0.5, -0.3, -2.0
# A sign that can be a letter is seldom strewn in.
LETTER_STREWN = -6.0
# Signs at the end of a word that are punctuation, by how common that is; digits and signs that stand for no letters.
PUNCTUATION = {"!": -0.3, "|": -1.5, "+": -4.0, "@": -4.0, "$": -4.5}
NO_LETTER = -3.5
STREWN_SIGNS = frozenset(".-_*~'^/\\#%&=:,;\"`")

# Codes of the character model: 0 between words, a-z, one per code point from U+00DF to U+017F, one for the rest.
_FIRST, _LAST = 0xDF, 0x17F
ALPHABET = 27 + _LAST - _FIRST + 2


def _code_table() -> np.ndarray:
    table = np.zeros(0x250 + 1, dtype=np.int64)
    for cp in range(0x250):
        c = chr(cp).lower()
        if c.isalpha():
            table[cp] = _code_of(c)
    table[0x250] = ALPHABET - 1
    return table


def _code_of(letter: str) -> int:
    cp = ord(letter[0])
    if 97 <= cp <= 122:
        return cp - 96
    return 27 + cp - _FIRST if _FIRST <= cp <= _LAST else ALPHABET - 1


_CODES = _code_table().astype(np.int32)


def _trigram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of three letters, ascending, and how often each stands in the texts."""
    points = np.frombuffer("".join([f"\n{t}\n" for t in texts]).encode("utf-32-le"), dtype=np.uint32)
    text = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)) + 2)
    codes = _CODES[np.minimum(points, 0x250)]
    # One boundary between words: further non-letters of a text are skipped.
    keep = (codes != 0) | (np.r_[1, codes[:-1]] != 0) | (text != np.r_[-1, text[:-1]])
    codes, text = codes[keep], text[keep]
    tri = ((codes[:-2] * ALPHABET + codes[1:-1]) * ALPHABET + codes[2:])[text[:-2] == text[2:]].astype(np.int32)
    return np.unique(tri, return_counts=True)


def character_counts(docs: DataFrame) -> DataFrame:
    """code (of three letters), n: over all texts. At most ALPHABET ** 3 rows, whatever the size of docs."""

    def run(batches):
        seen: Counter = Counter()
        for chunk in text_chunks(batches):
            codes, times = _trigram_counts(texts_of(chunk))
            for code, n in zip(codes.tolist(), times.tolist(), strict=True):
                seen[code] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["code", "n"])

    return docs.select(column_of(docs, "text")).mapInArrow(run, "code long, n long").groupBy("code").agg(
        F.sum("n").alias("n"))


class CharacterModel:
    """Log-probability of a letter after two others: trigram, bigram and unigram shares, interpolated."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        a = ALPHABET
        one, two = np.zeros(a), np.zeros(a * a)
        np.add.at(one, codes % a, counts)
        np.add.at(two, codes % (a * a), counts)
        self.one = ((one + 0.5) / (one.sum() + 0.5 * a)).tolist()
        self.two = dict(zip(*self._nonzero(two), strict=True))
        self.three = dict(zip(codes.tolist(), counts.tolist(), strict=True))
        before_two, before_one = np.zeros(a * a), np.zeros(a)
        np.add.at(before_two, codes // a, counts)
        np.add.at(before_one, codes // a % a, counts)
        self.before_two = dict(zip(*self._nonzero(before_two), strict=True))
        self.before_one = before_one.tolist()

    @staticmethod
    def _nonzero(counts):
        at = np.flatnonzero(counts)
        return at.tolist(), counts[at].tolist()

    def log(self, before: int, last: int, new: int) -> float:
        a = ALPHABET
        p = 0.1 * self.one[new]
        if n := self.before_one[last]:
            p += 0.3 * self.two.get(last * a + new, 0) / n
        if n := self.before_two.get(before * a + last):
            p += 0.6 * self.three.get((before * a + last) * a + new, 0) / n
        return math.log(p)


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For each run of equal characters the strings it may stand for, with their costs. `word` is in lower case.

    Signs at the end are letters or punctuation, runs of three and more rather the latter.
    """
    slots, i = [], 0
    end = len(word.rstrip("".join(PUNCTUATION)))
    while i < len(word):
        c, j = word[i], i
        while j < len(word) and word[j] == c:
            j += 1
        n = j - i
        if c.isalpha():
            readings = [(c * n, 0.0)] if n < 3 else [(c, REPEATED), (c * 2, REPEATED)]
            if c in LEET:
                readings += [(x, SUBSTITUTED) for x in LEET[c]]
        elif c == " ":
            readings = [("", GAP_ADDED), (" ", GAP_MEANT)]
        elif c in LEET:
            most = min(n, 2)
            none = PUNCTUATION[c] / max(1, n - 1) if i >= end else LETTER_STREWN
            readings = [(x * k, SUBSTITUTED * k) for x in LEET[c] for k in range(1, most + 1)] + [("", none)]
        else:
            readings = [("", STREWN)] if c in STREWN_SIGNS else [(" ", 0.0)]
        slots.append(readings)
        i = j
    return slots


def viterbi(word: str, model: CharacterModel, least: float = -math.inf) -> str:
    """The most likely reading of the lattice of `word`; ties go to the reading listed first. Empty, if not above `least`."""
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for readings in [*lattice(word), [(" ", 0.0)]]:
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (before, last), (score, path) in best.items():
            for text, cost in readings:
                b, l, s = before, last, score + cost
                for c in text:
                    code = 0 if c == " " else _code_of(c)
                    if code or l:
                        s += model.log(b, l, code)
                        b, l = l, code
                known = after.get((b, l))
                if known is None or s > known[0]:
                    after[b, l] = (s, (path, text))
        best = after
    score, path = max(best.values(), key=lambda x: x[0])
    if score <= least:
        return ""
    parts: list[str] = []
    while path:
        path, text = path
        parts.append(text)
    return "".join(reversed(parts))


@dataclass
class Restorer:
    """Restored words of a text. Pieces between white space are kept once decoded."""

    model: CharacterModel
    of_piece: BoundedCache = field(init=False)

    def __post_init__(self):
        self.of_piece = BoundedCache(self.piece)

    def piece(self, piece: str) -> tuple[str, ...]:
        low = piece.lower()
        core = low.strip("\"'.,;:?()[]{}<>«»¿¡…-*#%&_=~`^/\\")
        if not core:
            return ()
        if core.isalpha() and not _repeats(core):
            return (core,)
        if not any(c.isalpha() for c in core):
            # A number, or a word all in digits and signs: whichever is more likely.
            signs = sum(c in LEET for c in core)
            read = viterbi(core, self.model, NO_LETTER * signs) if signs > 1 else ""
            return tuple(read.split()) if len(read.strip()) > 1 else ()
        return tuple(viterbi(core, self.model).split())

    def words(self, text: str) -> list[str]:
        pieces = white_space_tokens(text)
        single = [i for i, p in enumerate(pieces) if len(p) == 1]
        out: list[str] = []
        if len(single) >= 3:
            at = 0
            for first, last in _runs(single):
                joined = " ".join(pieces[first:last + 1]).lower()
                if any(c.isalpha() for c in joined):
                    for p in pieces[at:first]:
                        out.extend(self.of_piece[p])
                    out.extend(viterbi(joined, self.model).split())
                    at = last + 1
            pieces = pieces[at:]
        for p in pieces:
            out.extend(self.of_piece[p])
        return out


def _repeats(word: str) -> bool:
    return any(a == b == c for a, b, c in zip(word, word[1:], word[2:], strict=False))


def _runs(places: list[int]) -> list[tuple[int, int]]:
    """First and last of each run of three or more consecutive places."""
    runs, start = [], 0
    for k in range(1, len(places) + 1):
        if k == len(places) or places[k] != places[k - 1] + 1:
            if k - start >= 3:
                runs.append((places[start], places[k - 1]))
            start = k
    return runs


BEGINNINGS = (4, 5, 6)


def features(word: str) -> list[str]:
    """The word itself, and its beginnings where it is longer than they are."""
    return [word] + [f"{word[:n]}~" for n in BEGINNINGS if len(word) > n]


def weight_of_counts(counts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """How often a feature stands in a text, relative to its length; short texts count as 50 words."""
    return np.log1p(100.0 * counts / np.maximum(words, 50))


@dataclass
class ToxicModel:
    names: dict[str, int]
    weights: np.ndarray
    bias: float

    def score(self, restored: list[str]) -> float:
        return self.scores([restored])[0]

    def scores(self, texts: list[list[str]]) -> list[float]:
        found = [self.found(words) for words in texts]
        return [self._one(f, len(w)) for f, w in zip(found, texts, strict=True)]

    def found(self, words: list[str]) -> Counter:
        names = self.names
        return Counter(names[f] for w, n in Counter(words).items() for f in features(w) if f in names for _ in range(n))

    def _one(self, found: Counter, words: int) -> float:
        z = self.bias
        if found:
            ids = np.fromiter(found.keys(), dtype=np.int64)
            n = np.fromiter(found.values(), dtype=np.float64)
            z += float(self.weights[ids] @ weight_of_counts(n, np.float64(words)))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def fit_logistic(rows, ids, values, labels, dims: int, l2: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Full-batch gradient descent (Adam) on a sparse table; rows, ids and values are its entries.

    Both kinds of rows weigh the same in all, so that rare toxic rows are not scored too low.
    """
    w, b, n, share = np.zeros(dims), 0.0, len(labels), labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    m, v = np.zeros(dims + 1), np.zeros(dims + 1)
    for step in range(1, steps + 1):
        z = np.bincount(rows, values * w[ids], n) + b
        gap = weight * (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels)
        grad = np.append(np.bincount(ids, values * gap[rows], dims) / n + l2 * w, gap.mean())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w -= move[:-1]
        b -= move[-1]
    return w, b


def fit(
    docs: DataFrame, labels: DataFrame, model: CharacterModel, sample_rows: int = 20_000, max_features: int = 4096,
    min_docs: int = 3, min_chi: float = 7.0, l2: float = 1e-4,
) -> ToxicModel | None:
    """Fits on rows of docs that labels (doc_id, toxic; one row per doc_id) names; at most about `sample_rows`, by hash.

    max_features: size of the model; those that tell the two kinds apart best (chi-square, at least min_chi) are kept.
    """
    total = labels.count()
    if total > sample_rows:
        share = int(sample_rows / total * (1 << 30))
        labels = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < share)
    # At most about sample_rows rows of two numbers: the bound is what makes this broadcast safe.
    chosen = docs.select(column_of(docs, "doc_id"), column_of(docs, "text")).join(F.broadcast(labels), "doc_id")

    def restored(batches):
        restore = Restorer(model)
        for chunk in text_chunks(batches):
            words = [restore.words(text) for text in texts_of(chunk)]
            yield pa.RecordBatch.from_arrays(
                [chunk.column(2).cast(pa.int32()), pa.array(words, pa.list_(pa.string()))], names=["toxic", "words"])

    # Decoded once: the rest of the fit reads the words of the bounded sample.
    sample = stage(chosen.mapInArrow(restored, "toxic int, words array<string>"), "restored-words")

    def few_rows(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                yield batch.slice(i, 64)

    def tables(batches):
        seen: Counter = Counter()

        def counted():
            names, kinds = zip(*seen, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(kinds, pa.int32()), pa.array(list(seen.values()), pa.int64())],
                names=["feature", "toxic", "n"])

        for part in few_rows(batches):
            for words, t in zip(part.column(1).to_pylist(), part.column(0).to_pylist(), strict=True):
                seen.update((f, t) for f in {f for w in set(words) for f in features(w)})
            if len(seen) > 50_000:  # partial counts: what a task holds stays bounded
                yield counted()
                seen.clear()
        if seen:
            yield counted()

    kinds = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = kinds.get(1, 0), kinds.get(0, 0)
    if not bad or not good:
        return None
    found = sample.mapInArrow(tables, "feature string, toxic int, n long").groupBy("feature").agg(
        F.sum(F.expr("if(toxic = 1, n, 0)")).alias("a"), F.sum(F.expr("if(toxic = 0, n, 0)")).alias("b")).where(
        F.expr(f"a + b >= {min_docs}"))
    gap = F.expr(f"a * ({good}D - b) - b * ({bad}D - a)")
    both = F.expr("a + b")
    scale = F.lit((bad + good) / (bad * good))
    ranked = found.withColumn("chi", scale * gap * gap / (both * (F.lit(float(bad + good)) - both + 1))).where(
        F.col("chi") >= min_chi)
    top = ranked.orderBy(F.desc("chi"), "feature").limit(max_features).select("feature").collect()
    names = {r["feature"]: i for i, r in enumerate(top)}
    empty = ToxicModel(names, np.zeros(len(names)), 0.0)

    def entries(batches):
        for part in few_rows(batches):
            ids, counts, words = [], [], []
            for own in part.column(1).to_pylist():
                at = empty.found(own)
                ids.append(list(at))
                counts.append(list(at.values()))
                words.append(len(own))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32())), pa.array(words, pa.int64())],
                names=["toxic", "ids", "counts", "words"])

    # Bounded: sample_rows rows with the features of the model.
    table = sample.mapInArrow(entries, "toxic int, ids array<int>, counts array<int>, words long").toPandas()
    size = table["ids"].map(len).to_numpy()
    if not size.sum():
        return ToxicModel({}, np.zeros(0), math.log(bad / good))
    ids = np.concatenate(table["ids"].to_numpy()).astype(np.int64)
    counts = np.concatenate(table["counts"].to_numpy()).astype(np.float64)
    rows = np.repeat(np.arange(len(table)), size)
    values = weight_of_counts(counts, table["words"].to_numpy()[rows])
    w, b = fit_logistic(rows, ids, values, table["toxic"].to_numpy().astype(float), len(names), l2)
    used = np.flatnonzero(np.abs(w) > 1e-4)
    by_id = list(names)
    return ToxicModel({by_id[i]: k for k, i in enumerate(used)}, w[used], b)


def character_model(docs: DataFrame) -> CharacterModel:
    counts: pd.DataFrame = character_counts(docs).orderBy("code").toPandas()
    return CharacterModel(counts["code"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))


def score(
    docs: DataFrame, character: CharacterModel, model: ToxicModel | None, cut: float = 0.7,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns `keep`, score (0 to 1) and predicted (1 from `cut` on) for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast((character, model))
    state: dict[str, Restorer] = {}

    def work(texts):
        letters, toxic = shared.value
        if "restore" not in state:
            state["restore"] = Restorer(letters)
        if toxic is None:
            scores = [0.0] * len(texts)
        else:
            scores = toxic.scores([state["restore"].words(t) for t in texts])
        return scores, [int(s >= cut) for s in scores]

    return map_texts(docs, [("score", "double"), ("predicted", "int")], work, keep)


def keep_civil(docs: DataFrame, character: CharacterModel, model: ToxicModel | None, cut: float = 0.7) -> DataFrame:
    """The rows of docs whose score is below `cut`, with their columns."""
    plain = neutral(docs)
    return named_again(score(plain, character, model, cut, tuple(plain.columns)).where("predicted = 0"), docs)


def training_labels(labels: DataFrame, folds: int = 3, held_out: int = 1) -> DataFrame:
    """doc_id, toxic of the rows that may be learned from: crc32(doc_id) mod folds is not held_out. Conflicts: toxic."""
    return labels.where("doc_id is not null and toxic in (0, 1)").where(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held_out).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
