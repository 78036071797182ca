"""Token counts by heap-and-linked-list byte-pair merging: initial symbols minus merges, no ids emitted.

Cases: null or empty text counts 0 tokens; white space only counts 0; text of any length is read whole (time grows as
n log n in the longest word); repeated rows and ids give a row each; an empty table gives an empty result.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame

from tierloom.llm.common import Generations, map_texts, white_space_tokens
from tierloom.llm.word_bpe import open_word_bpe, per_process


class HeapCounter:
    """Counts the tokens of white-space-free pieces; keeps the counts of `bound` pieces and as many words."""

    def __init__(self, path: str, bound: int = 400_000):
        self.rules = open_word_bpe(path)
        self.by_pair = {p: (r, n) for r, (p, n) in enumerate(zip(self.rules.pairs, self.rules.merged, strict=True))}
        self.of_piece = Generations(self._piece, bound)
        self.of_word = Generations(self.word, bound)

    def _piece(self, piece: str) -> int:
        return sum([1 if isinstance(w, int) else self.of_word[w] for w in self.rules.words(piece)])

    def word(self, word: str) -> int:
        """Symbols of the word less the merges made, always taking the lowest rank, then the leftmost place."""
        symbol = self.rules.symbols(word)
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranked = self.by_pair
        heap = []
        for i in range(n - 1):
            pair = (symbol[i], symbol[i + 1])
            if pair in ranked:
                heap.append((ranked[pair][0], i, *pair))
        heapify(heap)
        merges = 0
        while heap:
            _, i, left, right = heappop(heap)
            j = after[i]
            if symbol[i] != left or j >= n or symbol[j] != right:
                continue  # one of the two has been merged meanwhile
            merges += 1
            symbol[i], symbol[j] = ranked[left, right][1], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (pair := (symbol[i], symbol[k])) in ranked:
                    heappush(heap, (ranked[pair][0], i, *pair))
            if (h := before[i]) >= 0 and (pair := (symbol[h], symbol[i])) in ranked:
                heappush(heap, (ranked[pair][0], h, *pair))
        return n - merges

    def text(self, text: str) -> int:
        return sum(map(self.of_piece.__getitem__, white_space_tokens(text)))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than `limit` tokens) for each row of docs."""

    def work(texts):
        counter = per_process(HeapCounter, tokenizer_path)
        tokens = [counter.text(t) for t in texts]
        return [len(t.encode()) for t in texts], tokens, [n > limit for n in tokens]

    return map_texts(docs, [("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean")], work)
