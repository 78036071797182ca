"""Benchmark decontamination: CGK random-walk embedding and bit-sampling LSH over item-sized windows of words.

Words are white-space-free pieces in lower case without outer punctuation. A document holds an item if some stretch of
its words is at most floor(max_edit_share * item words) word edits away from the item (0.8 similarity by default).

1. Items are cut into disjoint pieces of at most piece_words words, since walks over long windows fall out of step. Some
   piece of an edited item has at most its share of the edits, so it is enough to find every piece with that many.
2. A window is only embedded if it holds enough different word pairs of the benchmark. An edit destroys at most two
   pairs, so a window near a piece always does: this drops no match. The pairs are a bitmap of fixed size, whatever the
   benchmark.
3. The CGK walk reads a window with one random bit per (repetition, step, word): bit 1 moves on, bit 0 repeats the word.
   Sequences few edits apart then agree in most places of their walks. Each repetition samples a few places of the walk
   as its key; windows whose key is a key of some piece (again a fixed-size bitmap) go on, with their keys. Repetitions
   and samples are fitted for each window size: the fewest repetitions that reach `target_recall` on random pieces of
   that size with as many edits as they may have.
4. Equal keys join windows and items. A window reaches as far as the item around its piece may; overlapping ones were
   merged to one region before, so a passage is joined once.
5. Every pair of region and item is checked exactly, by Myers' bit-vector search for the item anywhere in the region.

Items of fewer than min_item_words words may have no edits, so their windows are looked up whole, by one hash of all their
words, and go the same way from there. In scripts that write no spaces every character is a word.

Cases: a null or empty text holds no item; null items, and those without a word, take no part;
texts are read whole, whatever their length; repeated rows each get their rows; repeated items each count; a null
item_id or doc_id is kept; empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.llm.common import (
    BoundedCache,
    column_of,
    named_again,
    neutral,
    text_chunks,
    texts_of,
    white_space_tokens,
)
from tierloom.sources.staging import stage

BITMAP_BITS = 22
_OUTER = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»¿¡…“”‘’–—"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_NO_WORD = np.uint64(0)


@dataclass(frozen=True)
class Settings:
    max_edit_share: float = 0.2
    min_item_words: int = 5
    size_step: float = 1.15  # window sizes form a geometric series; a piece uses the largest that fits
    piece_words: int = 30
    target_recall: float = 0.99  # of pieces with the most edits they may have
    most_repetitions: int = 64

    def edits(self, words: int) -> int:
        return math.floor(self.max_edit_share * words + 1e-9)

    def sizes(self, longest: int) -> list[int]:
        """Window sizes: those of items that are matched whole, then those of pieces."""
        whole = list(range(1, min(self.min_item_words, longest + 1)))
        out = [self.min_item_words]
        while out[-1] < longest:
            out.append(max(out[-1] + 1, int(out[-1] * self.size_step)))
        return whole + [s for s in out if s <= longest]

    def size_of(self, words: int, sizes: list[int]) -> int:
        return max(s for s in sizes if s <= words)

    def pieces(self, words: int) -> list[tuple[int, int]]:
        """(first, words) of the disjoint pieces of an item, which differ by at most one word."""
        n = math.ceil(words / self.piece_words)
        cut = [words * k // n for k in range(n + 1)]
        return [(a, z - a) for a, z in zip(cut, cut[1:], strict=False)]


# Scripts written without spaces: Thai and Lao, Burmese, Khmer, kana, Han (fixed ranges of the character tables).
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def word_hash(piece: str) -> int:
    word = piece.lower().strip(_OUTER)
    return (xxhash.xxh64_intdigest(word.encode(), 42) or 1) if word else 0


class WordHasher:
    def __init__(self):
        self.of_piece = BoundedCache(word_hash)

    def words(self, text: str) -> np.ndarray:
        if not text.isascii() and _UNSPACED.search(text):
            text = _UNSPACED.sub(r" \g<0> ", text)
        found = np.array([self.of_piece[p] for p in white_space_tokens(text)], dtype=np.uint64)
        return found[found != _NO_WORD]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


def pair_hashes(words: np.ndarray) -> np.ndarray:
    return mix(words[:-1] * np.uint64(3) + words[1:])


class Bitmap:
    """Membership of 64-bit hashes in 2 ** BITMAP_BITS bits: never misses a member, seldom takes another for one."""

    def __init__(self, blocks: np.ndarray, bits: np.ndarray):
        self.blocks = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
        self.blocks[blocks] = bits.view(np.uint64)

    @staticmethod
    def place(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (hashes >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
        return at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)

    def __contains__(self, h: int) -> bool:
        return bool(self.has(np.array([h], dtype=np.uint64))[0])

    def has(self, hashes: np.ndarray) -> np.ndarray:
        block, bit = self.place(hashes)
        return (self.blocks[block] & bit) != 0


class Walk:
    """CGK embeddings of equally long windows, at the sampled places of every repetition.

    A repetition is the same whatever the number of repetitions.
    """

    def __init__(self, size: int, repetitions: int, samples: int):
        self.size, self.repetitions = size, repetitions
        steps = 2 * size
        self.sampled = np.zeros((steps, repetitions), dtype=bool)
        self.seeds = np.zeros((steps, repetitions), dtype=np.uint64)
        for k in range(repetitions):
            r = np.random.default_rng([size, samples, k])
            self.sampled[r.choice(steps, min(samples, steps), replace=False), k] = True
            self.seeds[:, k] = r.integers(1, 1 << 63, steps, dtype=np.uint64)

    def keys(self, windows: np.ndarray) -> np.ndarray:
        """windows: rows of `size` words. One key per row and repetition; all repetitions walk side by side."""
        n, repetitions = len(windows), self.repetitions
        rows = np.arange(n)[:, None]
        padded = np.concatenate([windows, np.zeros((n, 1), dtype=np.uint64)], axis=1)
        at = np.zeros((n, repetitions), dtype=np.int64)
        out = np.tile(np.arange(repetitions, dtype=np.uint64) + np.uint64(self.size << 8), (n, 1))
        for step in range(int(np.flatnonzero(self.sampled.any(axis=1))[-1]) + 1):
            word = padded[rows, at]
            taken = self.sampled[step]
            out[:, taken] = mix(out[:, taken] ^ word[:, taken])
            at += (mix(word ^ self.seeds[step]) & np.uint64(1)).astype(np.int64)
            np.minimum(at, self.size, out=at)
        return out


class Whole:
    """Stands for a walk where windows are matched whole: one key, of all words."""

    def __init__(self, size: int):
        self.size = size

    def keys(self, windows: np.ndarray) -> np.ndarray:
        key = np.full(len(windows), self.size << 8, dtype=np.uint64)
        for step in range(self.size):
            key = mix(key ^ windows[:, step])
        return key[:, None]


def edited_pieces(size: int, edits: int, pieces: int) -> tuple[np.ndarray, np.ndarray]:
    """pieces x size random words, and pieces x start x size: the windows around them after `edits` random edits, of
    all kinds in the even pieces and insertions only in the odd ones."""
    r = np.random.default_rng([size, edits, pieces])
    plain = r.integers(1, 1 << 63, (pieces, size), dtype=np.uint64)
    windows = np.empty((pieces, 2 * edits + 1, size), dtype=np.uint64)
    for k, piece in enumerate(plain.tolist()):
        for kind in r.integers(0, 3, edits).tolist() if k % 2 == 0 else [0] * edits:
            at, word = int(r.integers(len(piece))), int(r.integers(1, 1 << 63))
            piece[at:at + (kind > 0)] = [word] if kind < 2 else []
        around = r.integers(1, 1 << 63, 2 * (size + 2 * edits), dtype=np.uint64)
        text = np.concatenate([around[:edits], np.array(piece, dtype=np.uint64), around[edits:]])
        windows[k] = np.lib.stride_tricks.sliding_window_view(text, size)[:2 * edits + 1]
    return plain, windows


_FITTED: dict[tuple[int, int, float, int], tuple[int, int, float]] = {}


def fitted(size: int, edits: int, settings: Settings, pieces: int = 300) -> tuple[int, int, float]:
    """(repetitions, samples, measured recall): the fewest repetitions that find pieces of `size` words with `edits`
    edits at the target recall; with as many samples as that allows, since they keep other windows out. If none
    reaches the target, the ones that come nearest, with a warning that states the recall."""
    name = (size, edits, settings.target_recall, settings.most_repetitions)
    if name not in _FITTED:
        plain, windows = edited_pieces(size, edits, pieces)
        best = (0, 0, -1.0)
        for samples in (3, 2, 1):
            walk = Walk(size, settings.most_repetitions, samples)
            own = walk.keys(plain)
            around = walk.keys(windows.reshape(-1, size)).reshape(pieces, -1, settings.most_repetitions)
            found = np.logical_or.accumulate((around == own[:, None]).any(axis=1), axis=1).mean(axis=0)
            enough = int(np.argmax(found >= min(settings.target_recall, found[-1])))
            if found[-1] > best[2]:
                best = (enough + 1, samples, float(found[enough]))
            if found[-1] >= settings.target_recall:
                break
        if best[2] < settings.target_recall:
            warnings.warn(f"windows of {size} words with {edits} edits: recall {best[2]:.3f} at {best[0]} repetitions", stacklevel=2)
        _FITTED[name] = best
    return _FITTED[name]


@dataclass(frozen=True)
class Window:
    """What a window size needs to know of the pieces that use it."""

    pairs: int  # fewest different pairs of a piece
    edits: int  # most edits of a piece that has at most its share
    before: int  # how far the item around a piece may reach, from the first word of the window
    after: int
    repetitions: int
    samples: int


def search(item: list[int], region: list[int], most: int) -> tuple[int, int] | None:
    """Fewest word edits between the item and any stretch of the region, and the last word of the first such stretch.

    Myers' bit vectors over words: bit i of `up` / `down` says that row i of the column rises / falls by one.
    """
    m = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    up, down, far, best = full, 0, m, None
    for j, w in enumerate(region):
        equal = masks.get(w, 0)
        cross = (((equal & up) + up) ^ up) | equal | down
        rise = down | (full & ~(cross | up))
        fall = up & cross
        far += bool(rise & last) - bool(fall & last)
        rise, fall = rise << 1, fall << 1
        same = equal | down
        up = full & (fall | ~(same | rise))
        down = full & rise & same
        if far <= most and (best is None or far < best[0]):
            best = (far, j)
    return best


def stretch(item: list[int], region: list[int], most: int) -> tuple[int, int, int] | None:
    """(edits, first, last) of the best stretch of the region."""
    found = search(item, region, most)
    if found is None:
        return None
    edits, last = found
    # Backwards from the end: where the reversed item ends is where the stretch begins.
    back = search(item[::-1], region[last::-1], edits)
    return edits, last - (back[1] if back else last), last


@dataclass
class Index:
    """What every task needs of the benchmark: sizes and two bitmaps, both bounded."""

    used: dict[int, Window]  # by window size
    pairs: Bitmap
    keys: Bitmap

    def regions(self, texts: list[np.ndarray]) -> list[tuple[int, int, int, np.ndarray]]:
        """(text, first, last, keys) of the stretches in which some window has the key of an item.

        The texts are laid out one after the other with gaps that no window bridges, and windows of all texts are
        embedded together.
        """
        if not self.used or not texts:
            return []
        gap = max(n + w.edits for n, w in self.used.items()) + 1
        length = np.array([len(w) for w in texts], dtype=np.int64)
        offset = np.cumsum(np.r_[0, length[:-1] + gap])
        words = np.zeros(int(offset[-1] + length[-1]) + gap, dtype=np.uint64)
        of_text = np.full(len(words), -1, dtype=np.int64)
        for k, (o, w) in enumerate(zip(offset.tolist(), texts, strict=True)):
            words[o:o + len(w)] = w
            of_text[o:o + len(w)] = k
        pairs = np.zeros(len(words), dtype=np.uint64)  # that ends at this word; 0 if no item has it
        pairs[1:] = pair_hashes(words)
        pairs[(words == _NO_WORD) | np.r_[True, words[:-1] == _NO_WORD] | ~self.pairs.has(pairs)] = 0
        upto = np.cumsum(pairs != 0)
        marked = []
        for size, used in self.used.items():
            edits, least = used.edits, used.pairs - 2 * used.edits
            starts = np.flatnonzero(of_text[:len(words) - size - edits] >= 0)
            if not edits and not used.samples:  # matched whole: the last word must be of the same text
                starts = starts[of_text[starts + size - 1] == of_text[starts]]
            else:
                starts = starts[upto[starts + size + edits - 1] - upto[starts] >= least]
                starts = self.varied(pairs, starts, size + edits, least)
            walk = walk_of(size, used.repetitions, used.samples)
            windows = np.lib.stride_tricks.sliding_window_view(words, size)
            for i in range(0, len(starts), 4096):
                some = starts[i:i + 4096]
                keys = walk.keys(windows[some])
                known = self.keys.has(keys)
                for row in np.flatnonzero(known.any(axis=1)).tolist():
                    k = int(of_text[some[row]])
                    s = int(some[row] - offset[k])
                    marked.append((k, max(0, s - used.before), min(int(length[k]), s + used.after) - 1, keys[row, known[row]]))
        return merged(marked)

    @staticmethod
    def varied(pairs: np.ndarray, starts: np.ndarray, reach: int, least: int) -> np.ndarray:
        """The starts whose windows hold at least `least` different known pairs."""
        padded = np.concatenate([pairs[1:], np.zeros(reach, dtype=np.uint64)])
        windows = np.lib.stride_tricks.sliding_window_view(padded, reach - 1)
        kept = []
        for i in range(0, len(starts), 8192):
            own = np.sort(windows[starts[i:i + 8192]], axis=1)
            different = (own[:, 1:] != own[:, :-1]).sum(axis=1) + (own[:, 0] != 0)
            kept.append(starts[i:i + 8192][different >= least])
        return np.concatenate(kept) if kept else starts


_WALKS: dict[tuple[int, int, int], Walk] = {}


def walk_of(size: int, repetitions: int, samples: int) -> Walk | Whole:
    if not samples:
        return Whole(size)
    found = _WALKS.get((size, repetitions, samples))
    if found is None:
        found = _WALKS[size, repetitions, samples] = Walk(size, repetitions, samples)
    return found


def merged(marked: list[tuple[int, int, int, np.ndarray]]) -> list[tuple[int, int, int, np.ndarray]]:
    """Overlapping stretches of a text as one, with all their different keys."""
    out: list[list] = []
    for text, first, last, keys in sorted(marked, key=lambda x: x[:3]):
        if out and out[-1][0] == text and first <= out[-1][2] + 1:
            out[-1][2] = max(out[-1][2], last)
            out[-1][3].append(keys)
        else:
            out.append([text, first, last, [keys]])
    return [(k, a, z, np.unique(np.concatenate(found))) for k, a, z, found in out]


def _bitmap(hashes: DataFrame) -> Bitmap:
    """hashes: block, bits. At most 2 ** (BITMAP_BITS - 6) rows come back."""
    rows = hashes.groupBy("block").agg(F.bit_or("bits").alias("bits")).toPandas()
    return Bitmap(rows["block"].to_numpy(np.int64), rows["bits"].to_numpy(np.int64))


def find(
    docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings(), keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """The columns `keep` of docs, item_id, edits, item_words, first_word and last_word: a row for each region of a
    document and item with a stretch near the item (words counted from 0, without those that are punctuation only)."""
    spark = docs.sparkSession
    hasher: dict[str, WordHasher] = {}

    def words_of(text):
        if "own" not in hasher:
            hasher["own"] = WordHasher()
        return hasher["own"].words(text)

    def coded(batches):
        for chunk in text_chunks(batches):
            words = [words_of(t) for t in texts_of(chunk)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.view(np.int64) for x in words], pa.list_(pa.int64())), chunk.column(1)],
                names=["words", "item_id"])

    item_type = benchmark.schema["item_id"].dataType.simpleString()
    items = stage(benchmark.select(column_of(benchmark, "text"), column_of(benchmark, "item_id")).mapInArrow(
        coded, f"words array<long>, item_id {item_type}").where(F.size("words") > 0).withColumn(
        "item", F.monotonically_increasing_id()), "items")
    longest = items.agg(F.max(F.size("words"))).first()[0]
    if longest is None:
        longest = 0
    sizes = settings.sizes(min(longest, settings.piece_words))

    def item_keys(batches):
        for batch in batches:
            item, key = [], []
            for i, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = np.array(w, dtype=np.int64).view(np.uint64)
                for first, n in settings.pieces(len(w)):
                    size = settings.size_of(n, sizes)
                    walk = walk_of(size, windows[size].repetitions, windows[size].samples)
                    found = walk.keys(w[None, first:first + size])[0]
                    item += [i] * len(found)
                    key += found.view(np.int64).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(key, pa.int64())], names=["item", "key"])

    def pair_bits(batches):
        for batch in batches:
            for w in batch.column(0).to_pylist():
                block, bit = Bitmap.place(pair_hashes(np.array(w, dtype=np.int64).view(np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(bit.view(np.int64))], names=["block", "bits"])

    def piece_needs(batches):
        for batch in batches:
            out = []
            for w in batch.column(0).to_pylist():
                w, edits, pieces = np.array(w, dtype=np.int64).view(np.uint64), settings.edits(len(w)), settings.pieces(len(w))
                for first, n in pieces:
                    size = settings.size_of(n, sizes)
                    pairs = len(np.unique(pair_hashes(w[first:first + size])))
                    # Edits move the ends of the item against the piece, and the window against the piece, by at most `edits` each.
                    out.append((size, pairs, edits // len(pieces), first + 2 * edits, len(w) - first + 2 * edits))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int32()) for c in list(zip(*out, strict=True)) or [[]] * 5],
                names=["size", "pairs", "edits", "before", "after"])

    def key_bits(batches):
        for batch in batches:
            block, bit = Bitmap.place(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(bit.view(np.int64))], names=["block", "bits"])

    needs = items.select("words").mapInArrow(piece_needs, "size int, pairs int, edits int, before int, after int").groupBy(
        "size").agg(F.min("pairs").alias("pairs"), *[F.max(c).alias(c) for c in ("edits", "before", "after")]).orderBy(
        "size").collect()  # one row per window size
    windows = {
        r["size"]: Window(r["pairs"], r["edits"], r["before"], r["after"], *(
            fitted(r["size"], r["edits"], settings)[:2] if r["size"] >= settings.min_item_words else (1, 0)))
        for r in needs}
    keys = stage(items.select("item", "words").mapInArrow(item_keys, "item long, key long").distinct(), "item-keys")
    index = Index(
        windows,
        _bitmap(items.select("words").mapInArrow(pair_bits, "block long, bits long")),
        _bitmap(keys.select("key").mapInArrow(key_bits, "block long, bits long")))
    shared = spark.sparkContext.broadcast(index)
    kept = len(keep)

    def mark(batches):
        own = shared.value
        for chunk in text_chunks(batches):
            row, first, words, found = [], [], [], []
            texts = [words_of(t) for t in texts_of(chunk)]
            for k, a, z, region_keys in own.regions(texts):
                row.append(k)
                first.append(a)
                words.append(texts[k][a:z + 1].view(np.int64))
                found.append(region_keys.view(np.int64))
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [chunk.column(i).take(at) for i in range(kept)] + [
                    pa.array(first, pa.int64()), pa.array(words, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.int64()))],
                names=[*keep, "first", "words", "keys"])

    region_schema = T.StructType([
        *[T.StructField(c, docs.schema[c].dataType) for c in keep], T.StructField("first", T.LongType()),
        T.StructField("words", T.ArrayType(T.LongType())), T.StructField("keys", T.ArrayType(T.LongType()))])
    regions = stage(docs.select(*[column_of(docs, c) for c in dict.fromkeys([*keep, "text"])]).mapInArrow(
        mark, region_schema).withColumn("region", F.monotonically_increasing_id()), "regions")
    pairs = regions.select("region", F.explode("keys").alias("key")).join(keys, "key").select("region", "item").distinct()
    both = pairs.join(regions.drop("keys"), "region").join(
        items.select("item", "item_id", F.col("words").alias("item_text")), "item")

    def verify(batches):
        for batch in batches:
            item, region, first = (batch.column(i).to_pylist() for i in range(3))
            ok, out = [], []
            for k, (i, r, f) in enumerate(zip(item, region, first, strict=True)):
                best = stretch(i, r, settings.edits(len(i)))
                if best is not None:
                    ok.append(k)
                    out.append((best[0], len(i), f + best[1], f + best[2]))
            at = pa.array(ok, pa.int64())
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(at) for i in range(3, 4 + kept)] + [pa.array(list(c), pa.int64()) for c in columns],
                names=[*keep, "item_id", *_MEASURES])

    out_schema = T.StructType([
        *[T.StructField(c, docs.schema[c].dataType) for c in keep], T.StructField("item_id", benchmark.schema["item_id"].dataType),
        *[T.StructField(c, T.LongType()) for c in _MEASURES]])
    return both.select("item_text", "words", "first", *keep, "item_id").mapInArrow(verify, out_schema)


_MEASURES = ("edits", "item_words", "first_word", "last_word")


def best_places(found: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document and item: fewest edits, then the earliest place."""
    best = F.min(F.struct(*_MEASURES)).alias("best")
    return found.groupBy(*keep, "item_id").agg(best).select(*keep, "item_id", *[f"best.{c}" for c in _MEASURES])


def text_key() -> Column:
    return F.md5(F.coalesce(F.col("`text`"), F.lit("")).cast("binary"))


def clean(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of docs whose text holds no item, with their columns.

    Whether a text holds an item depends on the text alone, so rows are matched by a digest of it: ids may be null or
    repeated.
    """
    marked = neutral(docs).withColumn("digest", text_key())
    tainted = find(marked.select("digest", "text"), benchmark, settings, ("digest",)).select("digest").distinct()
    return named_again(marked.join(tainted, "digest", "left_anti"), docs)
