"""Secret scan: fixed patterns, and a character convolutional network in numpy over every candidate and its context.

A candidate is the value of an assignment, a long run of key characters with a digit or of mixed case, or a run of eight
or more characters that looks made up, right after a telling word (password, key, bearer and the like). The network sees
the characters before a candidate, its beginning and end, and those after it. It learns from findings of the patterns, from
rewritten findings (other values, alphabets, lengths, separators and telling words, put into contexts of the given
texts), and, as the others, from candidates that no pattern covers and from harmless made-up ones (numbers, dates, paths,
compounds); findings, others and places for made-up ones are drawn separately from all documents. Its output is calibrated (Platt)
on all candidates of all documents that are held out, and the threshold is the highest that keeps the wanted recall there. Candidates over it that no pattern covers are added.

Cases: null and empty texts have no spans; texts are scanned whole, in time linear in their length; overlapping finds of
different kinds are all kept; without any text the network is off, which is warned about; repeated rows give a row each; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import warnings
from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import column_of, map_texts, named_again, neutral, text_chunks, texts_of
from tierloom.sources.staging import stage

# The patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_ASSIGN, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "cnn")

_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# Access keys and hex runs of the least lengths lie inside such a run.
_LONG = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_DIGIT = re.compile(r"[0-9]")
_TELLING_WORDS = (
    "pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "login", "signature", "private")
_TELLING = re.compile(
    r"(?:" + "|".join(_TELLING_WORDS) + r")[A-Za-z_]{0,8}[^A-Za-z0-9\n]{1,4}(?:(?:is|was|with|for|to|of)[^A-Za-z0-9\n]{1,3})?"
    r"""([A-Za-z0-9+/_.=!@#$%^&*-]{8,})""", re.IGNORECASE | re.ASCII)

BEFORE, INSIDE, AFTER, END = 24, 40, 16, 12  # of a longer candidate the last END characters take the place inside
WIDTH = BEFORE + INSIDE + AFTER
_OTHER, _PAD = 127, 0  # codes of characters beyond ASCII, and of places outside the text or the part


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int

    def __str__(self) -> str:
        return f"{self.kind}:{self.start}:{self.end}"


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def made_up(part: str) -> bool:
    """Holds a digit, or mixes upper and lower case as words do not, or is long."""
    if _DIGIT.search(part) or len(part) >= 24:
        return True
    tail = part[1:]
    return tail != tail.lower() and part != part.upper()


def find(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """The pattern findings, and the candidates (start, end)."""
    spans, candidates = [], set()
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                spans.append(Span("assign", m.start(), m.end()))
                candidates.add(m.span(2))
    if any(k in low for k in _TELLING_WORDS):
        for m in _TELLING.finditer(text):
            value = m.group(1).rstrip(".!-=")
            if len(value) >= 8 and made_up(value):
                candidates.add((m.start(1), m.start(1) + len(value)))
    for run in _LONG.finditer(text):
        part, at = run.group(), run.start()
        if made_up(part):
            candidates.add(run.span())
        for m in ACCESS.finditer(part):
            if m.end() - m.start() >= LEAST_ACCESS:
                spans.append(Span("access", at + m.start(), at + m.end()))
        for m in HEX.finditer(part):
            if m.end() - m.start() >= LEAST_HEX:
                spans.append(Span("hex", at + m.start(), at + m.end()))
    return in_order(spans), sorted(candidates)


def covered(candidates: list[tuple[int, int]], spans: list[Span]) -> list[bool]:
    """Whether a span overlaps each candidate; spans in order of their starts."""
    starts, reach = [s.start for s in spans], list(accumulate((s.end for s in spans), max))
    out = []
    for start, end in candidates:
        before = bisect_left(starts, end)  # spans that begin before the candidate ends
        out.append(before > 0 and reach[before - 1] > start)
    return out


def window(text: str, start: int, end: int) -> bytes:
    """Characters around and in the candidate as codes 1 to 127, 0 where there are none."""

    def coded(part: str) -> bytes:
        return bytes([c if 0 < c < _OTHER else _OTHER for c in map(ord, part)])

    inside = text[start:end] if end - start <= INSIDE else text[start:start + INSIDE - END] + text[end - END:end]
    return (
        coded(text[max(0, start - BEFORE):start]).rjust(BEFORE, b"\0") + coded(inside).ljust(INSIDE, b"\0")
        + coded(text[end:end + AFTER]).ljust(AFTER, b"\0"))


_LOWER, _UPPER, _FIGURES = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
_ALPHABETS = (
    _LOWER + _UPPER + _FIGURES, _LOWER + _UPPER, _LOWER + _FIGURES, _UPPER + _FIGURES, "0123456789abcdef", "0123456789ABCDEF",
    _LOWER + _UPPER + _FIGURES + "+/", _LOWER + _UPPER + _FIGURES + "_-")
_LEADS = (
    "pwd ", "password is ", "passphrase: ", "pass ", "bearer ", "Bearer ", "Authorization: Bearer ", "key: ", "key ", "key -> ", "api key ",
    "apikey: ", "auth ", "auth=", "login with ", "credential ", "credentials: ", "private key ", "signature ", "secret is ", "token ",
    "token == ", "access key ", "KEY=", "the token was ", "secret_key \"", "", "", "")


def _parts(around: bytes) -> tuple[str, str]:
    return tuple(bytes(c for c in part if c).decode("latin-1") for part in (around[:BEFORE], around[-AFTER:]))


def harmless(around: bytes, r: np.random.Generator, words: list[str]) -> bytes:
    """The window of a made-up candidate that is no secret (number, date, path, compound, name in code), in a given context."""
    left, right = _parts(around)
    some = [words[r.integers(len(words))] for _ in range(4)] if words else ["some", "plain", "words", "here"]
    figures = "".join(r.choice(list(_FIGURES), size=int(r.integers(1, 5))))
    value = (
        lambda: "".join(r.choice(list(_FIGURES), size=int(r.integers(8, 20)))),
        lambda: f"20{r.integers(10, 40)}-{r.integers(10, 13)}-{r.integers(10, 32)}T{r.integers(10, 24)}",
        lambda: "/".join([*some[:3], figures]), lambda: "-".join([*some[:2], figures, some[2]]),
        lambda: "_".join([some[0], figures, *some[1:]]), lambda: "".join(w.capitalize() for w in some[:3]),
        lambda: f"www.{some[0]}.com/{some[1]}{figures}", lambda: "".join(some)[:30] + "-" + some[0])[r.integers(8)]()
    text = f"{left} {_LEADS[r.integers(len(_LEADS))] if r.random() < 0.5 else ''}"
    return window(text + value + " " + right, len(text), len(text) + len(value))


def rewritten(around: bytes, r: np.random.Generator, words: list[str]) -> bytes:
    """The window of a made-up secret behind a lead of other words than the patterns take, in a given context."""
    left, right = _parts(around)
    lead = _LEADS[r.integers(len(_LEADS))]
    if lead and r.random() < 0.3 and words:  # a word with figures and signs, as people choose
        word = words[r.integers(len(words))][:9]
        value = word + "".join(r.choice(list(_FIGURES + "!@#$%"), size=max(1, 8 - len(word)) + int(r.integers(0, 3)))) + "xyz"[r.integers(3)]
        value = value.capitalize() if r.random() < 0.3 else value
    else:
        least = 12 if lead else 20
        alphabet = list(_ALPHABETS[r.integers(len(_ALPHABETS))])
        value = "".join(r.choice(alphabet, size=int(r.integers(least, 44))))
    text = f"{left} {lead}"
    return window(text + value + (" " if r.random() < 0.7 else "\"") + right, len(text), len(text) + len(value))


class CharCnn:
    """Character vectors, one convolution, the largest response inside and around the candidate, one dense layer."""

    REACH = 5

    def __init__(self, dims: int = 8, filters: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "vector": r.normal(0, 0.3, (128, dims)),
            "kernel": r.normal(0, 0.2, (self.REACH * dims, filters)),
            "shift": np.zeros(filters),
            "dense": r.normal(0, 0.2, 2 * filters),
            "bias": np.zeros(1),
        }
        self.p["vector"][_PAD] = 0.0
        self.scale, self.offset, self.threshold = 1.0, 0.0, 2.0
        n = WIDTH - self.REACH + 1
        middle = np.arange(n) + self.REACH // 2
        self.inside = (middle >= BEFORE) & (middle < BEFORE + INSIDE)

    def _forward(self, codes: np.ndarray):
        p, n = self.p, WIDTH - self.REACH + 1
        places = np.arange(n)[:, None] + np.arange(self.REACH)
        x = p["vector"][codes[:, places]].reshape(len(codes), n, -1)
        h = np.maximum(x @ p["kernel"] + p["shift"], 0)
        best_in = np.argmax(np.where(self.inside[:, None], h, -1), axis=1)
        best_out = np.argmax(np.where(self.inside[:, None], -1, h), axis=1)
        rows = np.arange(len(codes))[:, None]
        cols = np.arange(h.shape[2])[None]
        pooled = np.concatenate([h[rows, best_in, cols], h[rows, best_out, cols]], axis=1)
        return x, pooled, np.concatenate([best_in, best_out], axis=1), pooled @ p["dense"] + p["bias"][0]

    def logits(self, codes: np.ndarray, block: int = 512) -> np.ndarray:
        parts = [self._forward(codes[i:i + block])[3] for i in range(0, len(codes), block)]
        return np.concatenate(parts) if parts else np.zeros(0)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * self.logits(codes) + self.offset, -50, 50)))

    def _gradients(self, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray):
        p = self.p
        x, pooled, best, z = self._forward(codes)
        gap = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels) * weight / len(codes)
        f = p["kernel"].shape[1]
        back = gap[:, None] * p["dense"] * (pooled > 0)
        g = {"dense": pooled.T @ gap, "bias": np.array([gap.sum()]), "shift": back[:, :f].sum(0) + back[:, f:].sum(0)}
        taken = x[np.arange(len(codes))[:, None], best]  # sample, pooled value, patch
        g["kernel"] = np.einsum("npk,np->kp", taken, back)
        g["kernel"] = g["kernel"][:, :f] + g["kernel"][:, f:]
        kernel = np.concatenate([p["kernel"], p["kernel"]], axis=1)
        to_patch = (back[:, :, None] * kernel.T[None]).reshape(-1, p["vector"].shape[1])
        where = codes[np.arange(len(codes))[:, None, None], best[:, :, None] + np.arange(self.REACH)].reshape(-1)
        vector = np.zeros_like(p["vector"])
        np.add.at(vector, where, to_patch)
        vector[_PAD] = 0.0
        g["vector"] = vector
        return g

    def fit(self, codes: np.ndarray, labels: np.ndarray, epochs: int = 12, batch: int = 128, seed: int = 11) -> None:
        r = np.random.default_rng(seed)
        share = np.clip(labels.mean(), 0.02, 0.98)
        weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = r.permutation(len(codes))
            for i in range(0, len(codes), batch):
                at = order[i:i + batch]
                step += 1
                for k, g in self._gradients(codes[at], labels[at], weight[at]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)

    def calibrate(self, z: np.ndarray, labels: np.ndarray, weight: np.ndarray, recall: float) -> None:
        """Platt scaling of weighted outputs z, then the highest threshold at which at least `recall` of the secrets are found."""
        secrets = weight @ labels
        high, low = (secrets + 1) / (secrets + 2), 1 / (weight.sum() - secrets + 2)
        target = np.where(labels == 1, high, low)
        share = weight / weight.sum()
        a, b = 1.0, 0.0
        for _ in range(200):
            gap = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50))) - target
            a -= 0.5 * float(share @ (gap * z)) / max(1.0, float(share @ (z * z)))
            b -= 0.5 * float(share @ gap)
        self.scale, self.offset = a, b
        chance = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        order = np.argsort(-chance[labels == 1], kind="stable")
        if len(order):
            found = np.cumsum(weight[labels == 1][order])
            at = np.searchsorted(found, recall * found[-1] * (1 - 1e-12))
            self.threshold = float(chance[labels == 1][order][min(int(at), len(order) - 1)])


_BINS = 1024  # a unit of the output


def _binned(z: np.ndarray) -> np.ndarray:
    """Lower ends of bins, so that a threshold taken from them loses none of the outputs it stands for."""
    return np.floor(np.clip(z, -50, 50) * _BINS).astype(np.int64)


def _held(pick: str) -> bool:
    """Whether a window is kept from training, by a part of its hash that draws do not look at."""
    return int(pick[-1], 16) % 4 == 3


def _held_out(docs: DataFrame, net: CharCnn) -> DataFrame:
    """kind, bin, n: outputs for the held-out candidates (0) and findings (1) of all documents, copies once. At most some
    100,000 bins a kind, whatever the size of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for chunk in text_chunks(batches):
            found = {}
            for text in filter(None, texts_of(chunk)):
                spans, candidates = find(text)
                for c, kind in zip(candidates, covered(candidates, spans), strict=True):
                    w = window(text, *c)
                    pick = hashlib.md5(w).hexdigest()
                    if _held(pick):
                        found[pick, int(kind)] = w
            codes = np.frombuffer(b"".join(found.values()), dtype=np.uint8).reshape(-1, WIDTH)
            picks, kinds = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(picks, pa.string()), pa.array(kinds, pa.int32()), pa.array(_binned(shared.value.logits(codes)), pa.int64())],
                names=["pick", "kind", "bin"])

    return docs.select(column_of(docs, "text")).mapInArrow(run, "pick string, kind int, bin long").dropDuplicates(
        ["pick", "kind"]).groupBy("kind", "bin").agg(F.count(F.lit(1)).alias("n"))


def _candidate_table(docs: DataFrame, shares: tuple[float, ...] | None) -> DataFrame:
    """codes, kind, pick: of the candidates no pattern covers (0), the findings (1) and a place of each text (2) the share
    that a hash of the window picks; with shares None their numbers only: kind, n."""

    def run(batches):
        for chunk in text_chunks(batches):
            codes, kinds, order = [], [], []
            counts = [0, 0, 0]
            for text in filter(None, texts_of(chunk)):
                spans, candidates = find(text)
                place = len(text) * 2_654_435_761 % 2 ** 32 * len(text) >> 32
                found = [*zip(candidates, covered(candidates, spans), strict=True), ((place, place), 2)]
                for c, kind in found:
                    counts[kind] += 1
                    if shares is not None:
                        w = window(text, *c)
                        pick = hashlib.md5(w).hexdigest()
                        if int(pick[:8], 16) < shares[kind] * 2 ** 32:
                            codes.append(w)
                            kinds.append(int(kind))
                            order.append(pick)
            if shares is None:
                yield pa.RecordBatch.from_arrays([pa.array([0, 1, 2], pa.int32()), pa.array(counts)], names=["kind", "n"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes, pa.binary()), pa.array(kinds, pa.int32()), pa.array(order, pa.string())],
                    names=["codes", "kind", "pick"])

    return docs.select(column_of(docs, "text")).mapInArrow(
        run, "kind int, n long" if shares is None else "codes binary, kind int, pick string")


def fit(
    docs: DataFrame, sample_findings: int = 3_000, sample_others: int = 6_000, sample_places: int = 2_000, recall: float = 0.97,
    seed: int = 13,
) -> CharCnn | None:
    """Trains on at most about `sample_findings` findings and `sample_others` other candidates, drawn from all documents by
    a hash of the window, so copies count once, and on made-up secrets and harmless candidates at `sample_places` places of
    the texts. Calibration and threshold take all held-out windows of all documents; patterns and scan do not depend on the samples."""
    wanted = sample_others, sample_findings, sample_places
    counts = {r["kind"]: r["n"] for r in _candidate_table(docs, None).groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    shares = tuple(min(1.0, 1.5 * n / max(1, counts.get(i) or 0)) for i, n in enumerate(wanted))
    drawn = stage(_candidate_table(docs, shares).dropDuplicates(["pick", "kind"]), "secret-windows")
    tables = [drawn.where(F.col("kind") == i).orderBy("pick").limit(n).toPandas() for i, n in enumerate(wanted)]
    others, findings, places = (list(t["codes"]) for t in tables)
    if not places:
        warnings.warn("no text to learn from: the network is off", stacklevel=2)
        return None
    r = np.random.default_rng(seed)
    contexts = [*others, *findings, *places]
    words = sorted({w for c in contexts for w in re.findall(r"[a-z]{4,}", c[:BEFORE].decode("latin-1"))})
    secrets, plain = (
        [make(contexts[r.integers(len(contexts))], r, words) for _ in range(max(1_500, len(others) // 2))] for make in (rewritten, harmless))
    groups = [others, plain, findings, secrets]
    held = np.array([*map(_held, tables[0]["pick"]), *(i % 4 == 3 for i in range(len(plain))), *map(_held, tables[1]["pick"]),
                     *(i % 4 == 3 for i in range(len(secrets)))])
    codes = np.frombuffer(b"".join(w for g in groups for w in g), dtype=np.uint8).reshape(-1, WIDTH)
    labels = np.repeat([0, 0, 1, 1], [len(g) for g in groups])
    real = np.repeat([True, False, True, False], [len(g) for g in groups])
    order = r.permutation(np.flatnonzero(~held))
    net = CharCnn()
    net.fit(codes[order], labels[order])
    made = held & ~real
    z, kinds, weight = [_binned(net.logits(codes[made]))], [labels[made]], [np.ones(made.sum())]
    every = _held_out(docs, net).toPandas().sort_values(["kind", "bin"])
    for kind, table in every.groupby("kind"):
        # All that is held out, weighing as much beside the made-up ones as the training's share of it.
        n = table["n"].to_numpy(dtype=np.float64)
        z.append(table["bin"].to_numpy())
        kinds.append(np.full(len(n), kind))
        weight.append(n * min(1.0, wanted[kind] / 4 / n.sum()))
    net.calibrate(np.concatenate(z) / _BINS, np.concatenate(kinds), np.concatenate(weight), recall)
    return net


def spans_of(texts: list[str], net: CharCnn | None) -> tuple[list[list[Span]], list[list[Span]]]:
    """For each text the pattern findings, and all findings. All candidates go through the network in one go."""
    base, windows, owner = [], [], []
    for k, text in enumerate(texts):
        spans, candidates = find(text)
        base.append(spans)
        if net is not None:
            for c, known in zip(candidates, covered(candidates, spans), strict=True):
                if not known:
                    windows.append(window(text, *c))
                    owner.append((k, c))
    every = [list(s) for s in base]
    if windows:
        codes = np.frombuffer(b"".join(windows), dtype=np.uint8).reshape(len(windows), WIDTH)
        for (k, c), p in zip(owner, net.probability(codes), strict=True):
            if p >= net.threshold:
                every[k].append(Span("cnn", *c))
    return base, [in_order(s) for s in every]


def joined(spans: list[Span]) -> str:
    return ",".join(map(str, spans))


def scan(docs: DataFrame, net: CharCnn | None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (of the pattern findings) and spans (all findings)."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def work(texts):
        base, every = spans_of(texts, shared.value)
        counts = [[sum(s.kind == kind for s in spans) for spans in base] for kind in KINDS[:3]]
        return *counts, [hashlib.sha256(joined(s).encode()).hexdigest() for s in base], [joined(s) for s in every]

    return map_texts(docs, [
        ("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("base_sha256", "string"), ("spans", "string")], work)


def redacted(text: str, spans: list[Span], mark: str = "[secret]") -> str:
    """The text with each stretch that spans cover replaced by `mark`."""
    out, at, end = [], 0, -1
    for s in sorted(spans, key=lambda s: s.start):
        if s.start >= end:
            out += [text[at:s.start], mark]
        end = max(end, s.end)
        at = end
    return "".join(out) + text[at:]


def redact(docs: DataFrame, net: CharCnn | None) -> DataFrame:
    """docs with the secrets of the texts replaced; texts without any, null ones too, stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def work(texts):
        found = spans_of(texts, shared.value)[1]
        return [[redacted(t, s) if s else None for t, s in zip(texts, found, strict=True)]]

    plain = neutral(docs)
    changed = map_texts(plain, [("redacted", "string")], work, tuple(plain.columns))
    return named_again(changed.withColumn("text", F.coalesce("redacted", "text")), docs)
