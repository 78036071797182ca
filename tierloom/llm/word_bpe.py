"""A tokenizer file with word ends (model BPE, NFC and lower case, byte-level symbols): rules both BPE operators use.

White space never survives the split, and neither NFC nor lower case joins characters across it, so a text's tokens
are those of its white-space-free pieces, one after the other. That is what makes a cache per piece exact.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Callable

import regex

# Fixed by the byte-level format: bytes that stand for themselves, as inclusive ranges.
_OWN_RANGES = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))

# Up to here every Unicode version has the same letters, digits and lower case; beyond, the file's library decides.
_LAST_SHARED = "\u052f"


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next free one from U+0100 on."""
    own = [any(a <= b <= z for a, z in _OWN_RANGES) for b in range(256)]
    free = iter(range(256, 512))
    return [chr(b) if own[b] else chr(next(free)) for b in range(256)]


class WordBpe:
    """Symbols, merges and the split of one tokenizer file."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        letters = byte_alphabet()
        self.inner = [self.vocab[c] for c in letters]
        self.final = [self.vocab[c + suffix] for c in letters]
        self.pairs: list[tuple[int, int]] = []
        self.merged: list[int] = []
        for a, b in model["merges"]:
            self.pairs.append((self.vocab[a], self.vocab[b]))
            self.merged.append(self.vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self._pattern = split["pattern"]["Regex"]
        self._words = regex.compile(self._pattern).findall
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self._marks = tuple({t[0] for t in self.special})

    def words(self, piece: str) -> list[str | int]:
        """The words of a piece without white space, in order; a special token is given as its id."""
        if self._special and any(c in piece for c in self._marks):
            parts = self._special.split(piece)
        else:
            parts = [piece]
        found: list[str | int] = []
        for part in parts:
            if part in self.special:
                found.append(self.special[part])
            elif part:
                found.extend(self._split(part))
        return found

    def _split(self, part: str) -> list[str]:
        if part.isascii():
            return self._words(part.lower())
        if max(part) > _LAST_SHARED:
            normalizer, splitter = _library_split(self.path, self._pattern)
            return [w for w, _ in splitter.pre_tokenize_str(normalizer.normalize_str(part))]
        # Lower case is per character there: no final sigma.
        return self._words(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())

    def symbols(self, word: str) -> list[int]:
        raw = word.encode()
        return [self.inner[b] for b in raw[:-1]] + [self.final[raw[-1]]]


@functools.lru_cache(maxsize=4)
def _library_split(path: str, pattern: str):
    from tokenizers import Regex, Tokenizer
    from tokenizers.pre_tokenizers import Split

    return Tokenizer.from_file(path).normalizer, Split(Regex(pattern), "removed", invert=True)


@functools.lru_cache(maxsize=4)
def open_word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


@functools.lru_cache(maxsize=8)
def per_process(make: Callable, path: str):
    """make(path), once in a Python worker, so that caches outlive a task."""
    return make(path)
