"""BPE encoding and decoding by batched numpy merge rounds.

The symbols of all new words of a chunk lie in one flat array. Adjacent pairs are looked up by binary search among the
sorted pair keys, all of them once and then those next to a merge; a round takes the lowest rank of each word, and
merges. All places of that pair are merged at once where nothing created by the merge can have a lower rank; otherwise
only the leftmost place is, as one merge at a time would do. In a long word the lowest rank within the reach of two tokens
does instead of the whole word's, so that rounds depend on the reach and not on the length. Cases: null or empty text
encodes to no ids and decodes to the empty text; texts of any length are encoded whole; repeated rows give a row each; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
from pyspark.sql import DataFrame

from tierloom.llm.common import Generations, map_texts, white_space_tokens
from tierloom.llm.word_bpe import open_word_bpe, per_process

_NONE = np.iinfo(np.int32).max


class BatchedBpe:
    """Encodes many words at a time; keeps the ids and decoded text of pieces and of words seen, `bound` of each."""

    def __init__(self, path: str, bound: int = 200_000):
        self.rules = open_word_bpe(path)
        pairs = np.array(self.rules.pairs, dtype=np.int64).reshape(-1, 2)
        self.base = 1 + max([0, *self.rules.names])
        keys = pairs[:, 0] * self.base + pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank_of_key = keys[order], order.astype(np.int32)
        self.merged = np.array(self.rules.merged, dtype=np.int64)
        # The lowest rank among the merges a symbol takes part in: a merge is safe to repeat if its product has none below.
        lowest = np.full(self.base, _NONE, dtype=np.int32)
        ranks = np.arange(len(pairs), dtype=np.int32)
        for side in (0, 1):
            np.minimum.at(lowest, pairs[:, side], ranks)
        self.safe = lowest[self.merged] > ranks
        length = np.ones(self.base, dtype=np.int64)  # in first symbols
        for (a, b), m in zip(self.rules.pairs, self.rules.merged, strict=True):
            length[m] = max(length[m], length[a] + length[b])
        # Symbols this far apart never come together in a token, nor does what grows from one meet what grows from the other.
        self.reach = 2 * int(length.max()) + 2
        self.inner, self.final = (np.array(x, dtype=np.int64) for x in (self.rules.inner, self.rules.final))
        self.piece_ids = Generations(None, bound)
        self.word_ids = Generations(None, bound)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), _NONE, dtype=np.int32)
        key = left * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of_key[at], _NONE)

    def _apply(self, symbol, word, rank, hit):
        """Merges the pairs that begin at `hit` (not overlapping) and looks up the pairs they are now part of."""
        symbol[hit] = self.merged[rank[hit]]
        keep = np.ones(len(symbol), dtype=bool)
        keep[hit + 1] = False
        place = hit - np.arange(len(hit))  # of the products among what is kept
        symbol, word, rank = symbol[keep], word[keep], rank[keep]
        touched = np.unique(np.r_[place, place[place > 0] - 1])
        last = touched == len(symbol) - 1
        follows = np.minimum(touched + 1, len(symbol) - 1)
        apart = last | (word[touched] != word[follows])
        rank[touched] = np.where(apart, _NONE, self.ranks(symbol[touched], symbol[follows]))
        return symbol, word, rank

    def merge(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merges until nothing can be merged. word: number of the word of each symbol, ascending."""
        done_symbol, done_word = [], []
        symbol = symbol.copy()
        rank = np.full(len(symbol), _NONE, dtype=np.int32)  # of the pair that begins here
        if len(symbol):
            rank[:-1] = np.where(word[:-1] == word[1:], self.ranks(symbol[:-1], symbol[1:]), _NONE)
        while len(symbol):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            length = np.diff(np.r_[first, len(symbol)])
            if (length > 4 * self.reach).any():
                # The lowest of the surroundings does for a long word.
                best = self._lowest_around(rank, word)
                ended = np.repeat(lowest == _NONE, length)
            else:
                best = np.repeat(lowest, length)
                ended = best == _NONE
            if ended.any():
                done_symbol.append(symbol[ended])
                done_word.append(word[ended])
                symbol, word, rank, best = symbol[~ended], word[~ended], rank[~ended], best[~ended]
                if not len(symbol):
                    break
            symbol, word, rank = self._apply(symbol, word, rank, self._chosen(rank, best, word))
        if not done_word:
            return symbol, word
        symbol, word = np.concatenate(done_symbol), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def _lowest_around(self, rank: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The lowest rank within `reach` places to both sides; ranks of other words there can only delay a merge."""
        width = 2 * self.reach + 1
        low = np.r_[np.full(self.reach, _NONE, dtype=np.int32), rank, np.full(self.reach, _NONE, dtype=np.int32)]
        size = 1
        while 2 * size <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        rest = width - size
        return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low

    def _chosen(self, rank: np.ndarray, best: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places to merge at once, of those whose rank is the best of their surroundings.

        Overlapping places (a a a): of each run of neighbours of one rank every second from its left end, as far as the
        run is best from there on. A merge that is not safe to repeat only where none of its rank is close on its left.
        """
        may = np.flatnonzero((rank == best) & (rank != _NONE))
        of = rank[may]
        begins = np.r_[True, (np.diff(may) != 1) | (of[1:] != of[:-1])]
        # A run that goes on to the left, where it is not best, waits; word ends have no rank, so runs end there.
        left = np.maximum(may - 1, 0)
        waits = begins & (may > 0) & (rank[left] == of)
        start = np.maximum.accumulate(np.where(begins, np.arange(len(may)), 0))
        chosen = ~waits[start] & ((may - may[start]) % 2 == 0)
        unsafe = ~self.safe[of]
        if unsafe.any():
            risky = np.flatnonzero((rank != _NONE) & ~self.safe[np.minimum(rank, len(self.safe) - 1)])
            order = np.lexsort((risky, rank[risky], word[risky]))
            risky = risky[order]
            close = np.r_[False, (rank[risky][1:] == rank[risky][:-1]) & (word[risky][1:] == word[risky][:-1])
                          & (np.diff(risky) <= self.reach)]
            blocked = np.zeros(len(rank), dtype=bool)
            blocked[risky[close]] = True
            chosen = np.where(unsafe, ~blocked[may], chosen)
        return may[chosen]

    def learn(self, words: list[str]) -> list[tuple[bytes, str]]:
        """Ids and decoded text of the given words."""
        if not words:
            return []
        raw = [w.encode() for w in words]
        byte = np.frombuffer(b"".join(raw), dtype=np.uint8)
        length = np.array([len(b) for b in raw], dtype=np.int64)
        symbol = self.inner[byte]
        last = np.cumsum(length) - 1
        symbol[last] = self.final[byte[last]]
        symbol, word = self.merge(symbol, np.repeat(np.arange(len(words)), length))
        cuts = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        ids, names = symbol.astype("<u4").tobytes(), self.rules.names
        decoded = [names[i] for i in symbol.tolist()]
        return [(ids[4 * a:4 * z], " ".join(decoded[a:z])) for a, z in zip(cuts, cuts[1:], strict=False)]

    def pieces(self, wanted: set[str]) -> dict[str, tuple[bytes, str]]:
        """Ids and decoded text of different pieces without white space."""
        found, split, of_word = {}, {}, {}
        for piece in wanted:
            if (value := self.piece_ids.known(piece)) is not None:
                found[piece] = value
            else:
                split[piece] = words = self.rules.words(piece)
                for w in words:
                    if w not in of_word:
                        of_word[w] = (struct.pack("<I", w), self.rules.names[w]) if isinstance(w, int) else self.word_ids.known(w)
        new = [w for w, value in of_word.items() if value is None]
        for w, value in zip(new, self.learn(new), strict=True):
            of_word[w] = value
            self.word_ids.keep(w, value)
        for piece, words in split.items():
            if len(words) == 1:
                value = of_word[words[0]]
            else:
                value = b"".join([of_word[w][0] for w in words]), " ".join([of_word[w][1] for w in words])
            found[piece] = value
            self.piece_ids.keep(piece, value)
        return found

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """The ids of each text as little-endian unsigned 32-bit integers, and its decoded text.

        Decoding joins the token strings with a space, as the file names no decoder.
        """
        split = [white_space_tokens(t) for t in texts]
        known = self.pieces({p for pieces in split for p in pieces})
        ids, decoded = [], []
        for pieces in split:
            found = [known[p] for p in pieces]
            ids.append(b"".join([f[0] for f in found]))
            decoded.append(" ".join([f[1] for f in found if f[1]]))
        return ids, decoded



def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, ids (array<int>) and decoded text of each row."""

    def work(texts):
        ids, decoded = per_process(BatchedBpe, tokenizer_path).encode(texts)
        return [np.frombuffer(i, dtype="<u4").astype(np.int32) for i in ids], decoded

    return map_texts(docs, [("ids", "array<int>"), ("decoded", "string")], work)


def encode_digests(docs: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers) and decoded_sha256."""

    def work(texts):
        ids, decoded = per_process(BatchedBpe, tokenizer_path).encode(texts)
        return (
            [len(i) // 4 for i in ids], [hashlib.sha256(i).hexdigest() for i in ids],
            [hashlib.sha256(d.encode()).hexdigest() for d in decoded])

    return map_texts(
        docs, [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")], work, keep)
