"""Language identification by rank-order profiles and the out-of-place distance.

A language's profile is its most frequent letter n-grams (n = 1 to 3, words padded with a space), most frequent first.
A text's own profile is compared with each: the sum over its n-grams of how far their ranks are apart, at most
`profile_size` each. The nearest language wins; ties go to the first in alphabetical order.

Cases: a null text, or one without a letter, is `und` with score 0; without training rows every text is; whole texts
are profiled whatever their length; repeated rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierloom.llm.common import column_of, map_texts, text_chunks, texts_of

UNDETERMINED = "und"
PROFILE_SIZE = 300
_BITS = 21  # of a code point; three fill an n-gram code
_GAP = 32  # what stands between words


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of the text's words, ascending, and how often each stands in it. Empty without a letter."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), dtype=np.uint32)
    p = np.where(_letters()[points], points, _GAP).astype(np.int64)
    p = p[np.r_[True, (p[1:] != _GAP) | (p[:-1] != _GAP)]]
    letter = p != _GAP
    two = (p[:-1] << _BITS | p[1:])[letter[:-1] | letter[1:]]
    three = ((p[:-2] << _BITS | p[1:-1]) << _BITS | p[2:])[letter[1:-1]]
    codes = np.concatenate([p[letter], two, three])
    if not len(codes):
        return codes, codes
    codes.sort()
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.diff(np.r_[first, len(codes)])


def merged(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(codes, return_inverse=True)
    return distinct, np.bincount(at, times, len(distinct)).astype(np.int64)


def top(codes: np.ndarray, times: np.ndarray, size: int) -> np.ndarray:
    """The `size` most frequent codes; ties to the smaller code. codes are ascending."""
    return codes[np.argsort(-times, kind="stable")[:size]]


@dataclass
class Profiles:
    languages: list[str]
    codes: np.ndarray  # ascending, of all profiles
    ranks: np.ndarray  # code x language; far beyond the profile size where the profile lacks the code
    size: int

    @staticmethod
    def of(rows: list[tuple[str, int, int]], size: int) -> Profiles:
        """rows: language, code, rank from 0."""
        languages = sorted({r[0] for r in rows})
        codes = np.unique(np.array([r[1] for r in rows], dtype=np.int64))
        ranks = np.full((len(codes), len(languages)), 1 << 30, dtype=np.int64)
        column = {x: i for i, x in enumerate(languages)}
        for language, code, rank in rows:
            ranks[np.searchsorted(codes, code), column[language]] = rank
        return Profiles(languages, codes, ranks, size)

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Out-of-place distance of a text's profile to each language."""
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        rank = np.where(known[:, None], self.ranks[at], 1 << 30)
        return np.minimum(np.abs(rank - np.arange(len(own))[:, None]), self.size).sum(axis=0)

    def predict(self, own: np.ndarray) -> tuple[str, float]:
        """The nearest language, and by how much of the largest possible distance it is near."""
        if not len(own) or not self.languages:
            return UNDETERMINED, 0.0
        far = self.distances(own)
        best = int(np.argmin(far))
        return self.languages[best], 1.0 - float(far[best]) / (self.size * len(own))


def learn(docs: DataFrame, profile_size: int = PROFILE_SIZE) -> Profiles:
    """Profiles of the languages of docs (text, lang), from all its rows with a language."""

    def run(batches):
        own: dict[str, list] = {}
        for chunk in text_chunks(batches):
            by_language: dict[str, list] = {}
            for text, language in zip(texts_of(chunk), chunk.column(1).to_pylist(), strict=True):
                by_language.setdefault(language, []).append(gram_counts(text))
            for language, found in by_language.items():
                found += own.get(language, [])
                own[language] = [merged(np.concatenate([c for c, _ in found]), np.concatenate([n for _, n in found]))]
        for language, [(codes, times)] in own.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(codes), pa.string()), pa.array(codes), pa.array(times)], names=["lang", "code", "n"])

    counts = docs.where("lang is not null").select(column_of(docs, "text"), column_of(docs, "lang")).mapInArrow(
        run, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # First among each language's codes of equal remainder, then among those left: no task ranks a whole language.
    order = (F.desc("n"), F.asc("code"))
    part = Window.partitionBy("lang", F.pmod("code", F.lit(64))).orderBy(*order)
    rank = Window.partitionBy("lang").orderBy(*order)
    best = counts.withColumn("r", F.row_number().over(part)).where(F.col("r") <= profile_size).withColumn(
        "r", F.row_number().over(rank)).where(F.col("r") <= profile_size)
    # profile_size rows for each language.
    rows = [(r["lang"], r["code"], r["r"] - 1) for r in best.select("lang", "code", "r").collect()]
    return Profiles.of(rows, profile_size)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1, higher: nearer to the profile) of every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def work(texts):
        p = shared.value
        found = [p.predict(top(*gram_counts(t), p.size)) for t in texts]
        return [x for x, _ in found], [s for _, s in found]

    return map_texts(docs, [("lang_pred", "string"), ("score", "double")], work)
