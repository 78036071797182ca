import time
import string
"""Language, licence, secret and toxicity scans against brute force, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tierloom.llm import langid, license_scan, secret_cnn, toxicity
from tierloom.llm.queries import REGISTRY
from tests_llm_helpers import prose


def documents(spark, sf):
    return {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


# Language


def brute_grams(text):
    found = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        padded = f" {word} "
        for n in (1, 2, 3):
            found.update(padded[i:i + n] for i in range(len(padded) - n + 1) if padded[i:i + n] != " ")
    return found


def gram_code(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


@pytest.mark.parametrize("text", ["", "  ", "42", "a", "Hé llo, the THE cat 42 x", "Σας 你好 İ", prose(3, 50)])
def test_gram_counts(text):
    codes, times = langid.gram_counts(text)
    assert dict(zip(codes.tolist(), times.tolist(), strict=True)) == {gram_code(g): n for g, n in brute_grams(text).items()}


def test_language_equals_brute_force(spark, sf):
    docs = documents(spark, sf)
    held = {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in docs}
    counts = {}
    for d, r in docs.items():
        if not held[d] and r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(brute_grams(r.text))
    def ranked(c):
        return [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], gram_code(x[0])))[:300]]
    profiles = {x: {g: i for i, g in enumerate(ranked(c))} for x, c in counts.items()}
    right = 0
    for r in REGISTRY["op9_language"](spark, sf).collect():
        own = ranked(brute_grams(docs[r.doc_id].text))
        far = {x: sum(min(300, abs(p.get(g, 10**9) - i)) for i, g in enumerate(own)) for x, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert (r.held_out, r.lang_pred) == (held[r.doc_id], best)
        assert r.score == pytest.approx(1 - far[best] / (300 * len(own)))
        right += r.lang_pred == docs[r.doc_id].lang
    assert right > 0.97 * len(docs)


def test_language_odd_rows(odd, none):
    profiles = langid.learn(odd)
    rows = langid.identify(odd, profiles).collect()
    assert len(rows) == odd.count()
    assert Counter(r.lang_pred for r in rows)["und"] == 4  # null, empty, white space, signs
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in langid.identify(odd, langid.learn(none)).collect()} == {"und"}
    assert langid.identify(none, profiles).count() == 0


# Licences


def test_matching_statistics_equal_brute_force():
    r = random.Random(3)
    for _ in range(100):
        sequences = [[r.randint(0, 2) for _ in range(r.randint(1, 12))] for _ in range(5)]
        scanner = license_scan.Scanner()
        scanner.automaton = license_scan.SuffixAutomaton(sequences)
        text = [r.randint(0, 3) for _ in range(40)]
        lengths, states = scanner.statistics(text)
        for i in range(40):
            runs = [text[i - n + 1:i + 1] for n in range(1, i + 2)]
            def holders(run):
                return {k for k, s in enumerate(sequences) if any(run == s[j:j + len(run)] for j in range(len(s)))}
            longest = max((len(run) for run in runs if holders(run)), default=0)
            assert lengths[i] == longest
            if longest:
                run = runs[longest - 1]
                assert sorted(scanner.automaton.ends(states[i])) == [
                    (k, j + longest - 1) for k, s in enumerate(sequences) for j in range(len(s)) if run == s[j:j + longest]]


def brute_chain(text, template, least_match, gap):
    """Most template words that an advancing chain of words of long matches covers, by dynamic programming over word pairs."""
    n, m = len(text), len(template)
    same = [[text[i] == template[j] for j in range(m)] for i in range(n)]
    # The longest run ending at each word of the text, and the word pairs on runs that no longer run goes on from.
    longest = [max((next((k for k in range(min(i, j) + 1) if not same[i - k][j - k]), min(i, j) + 1) for j in range(m)), default=0) for i in range(n)]
    pairs = set()
    for i in range(n):
        if longest[i] >= least_match and (i + 1 == n or longest[i + 1] <= longest[i]):
            for j in range(longest[i] - 1, m):
                if all(same[i - k][j - k] for k in range(longest[i])):
                    pairs |= {(i - k, j - k) for k in range(longest[i])}
    best = {}
    for i, j in sorted(pairs):
        best[i, j] = 1 + max((v for (x, y), v in best.items() if x < i and y < j and i - x <= gap + 1), default=0)
    return max(best.values(), default=0)


def test_chains_equal_brute_force():
    r = random.Random(8)
    met = 0
    for _ in range(300):
        template = [f"t{r.randrange(12)}" for _ in range(r.randint(4, 14))]
        text = []
        for _ in range(r.randint(1, 4)):
            a = r.randrange(len(template))
            text += template[a:a + r.randint(1, 9)] + [f"t{r.randrange(14)}" for _ in range(r.randint(0, 4))]
        scanner = license_scan.TextScanner([("x", " ".join(template))], phrases=(), least_match=2, least_share=0.0, gap=2)
        spans = scanner.scan(" ".join(text))[2]
        assert max((s.covered for s in spans), default=0) == brute_chain(text, template, 2, 2)
        assert all(s.last < t.first for s, t in zip(spans, spans[1:], strict=False))
        met += bool(spans)
    assert met > 200


def test_repeated_and_shuffled_parts_are_no_licence():
    scan = license_scan.TextScanner().scan
    bsd = dict(license_scan.NOTICES)["bsd"].split()
    parts = [bsd[i:i + 9] for i in range(0, len(bsd), 9)]
    random.Random(1).shuffle(parts)
    for text in ("copies of the software " * 12, "redistribution and use " * 8, " ".join(w for p in parts for w in p),
                 "permission is hereby granted", "the software " * 40_000):
        assert scan(text)[2] == []


def test_whole_licences_are_found_with_changes():
    texts = dict(license_scan.NOTICES)
    scan = license_scan.TextScanner().scan
    mit = texts["mit"].replace("THE AUTHORS OR COPYRIGHT HOLDERS", "JANE DOE, HER HEIRS OR THE ACME CORPORATION")
    wrapped = "/*\n * " + "\n * ".join(mit.split("\n")) + "\n */ int main() { return 0; }"
    cut = " ".join(texts["zlib"].split()[8:])
    n, _, spans = scan(f"Copyright 2020 X. {wrapped} and more words in between, quite a few of them {cut} {cut}")
    assert [s.label for s in spans] == ["mit", "zlib", "zlib"]
    assert all(s.share > 0.9 for s in spans) and all(s.last < t.first for s, t in zip(spans, spans[1:], strict=False))
    text = ("x This program is free software; you can redistribute it and modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation; either version 2 of the License, or any later "
            "version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
            "even the implied warranty of MERCHANTABILITY.")
    n, places, spans = scan(text)
    assert places == [(18, "gpl")] and [(s.label, s.first, s.last) for s in spans] == [("gpl", 1, n - 1)]


def test_templates_come_from_a_table(spark):
    long = prose(77, 3000)
    rows = spark.createDataFrame([("house", long), ("house", long), (None, "x"), ("y", None)], "label string, text string")
    given = license_scan.templates(rows)
    assert given == (("house", long),)
    words = long.split()
    changed = words[:900] + ["inserted"] * 3 + words[905:2000] + words[2100:]
    docs = spark.createDataFrame([(1, "before " + " ".join(changed)), (2, prose(5, 3000))], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan_digest(docs, given).collect()}
    assert got[1].labels == "house" and got[1].score > 0.95 and got[2].labels == ""


def test_licences_equal_brute_force(spark, sf):
    docs = documents(spark, sf)
    for r in REGISTRY["op5_license_scan"](spark, sf).collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in docs[r.doc_id].text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = sorted((i, label) for phrase, label in license_scan.PHRASES for i in range(len(words))
                        if words[i:i + len(phrase.split())] == phrase.split())
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score == 1 or not places)


def test_licence_odd_rows(odd, none):
    rows = license_scan.scan_digest(odd).collect()
    assert len(rows) == odd.count() and sum(r.n_base for r in rows) == 1
    assert [r.labels for r in rows if r.n_base] == ["apache"]
    assert license_scan.scan_digest(none).count() == 0


# Secrets


def brute_spans(text):
    found = []
    for m in re.finditer(
            r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    for k, pattern, least in ((1, r"AKIA[A-Z0-9]+", 20), (2, r"[0-9a-f]+", 24)):
        found += [(m.start(), k, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found)


def test_patterns_equal_brute_force(spark, sf):
    docs = documents(spark, sf)
    for r in REGISTRY["op10_secrets"](spark, sf).collect():
        spans = brute_spans(docs[r.doc_id].text)
        joined = ",".join(f"{secret_cnn.KINDS[k]}:{a}:{z}" for a, k, z in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert set(joined.split(",")) <= set(r.spans.split(","))


@pytest.mark.parametrize("text", [
    "token=secret=abcdefgh", 'ToKeN: "a"="abcdefgh"', "toſken = abcdefgh", "pasſword=abcdefgh", "AKIAAKIA" + "A" * 20,
    "xAKIA" + "0" * 15, "xAKIA" + "0" * 16, "f" * 23, "f" * 24 + "g" + "0" * 30, "😀 api_key = 'ab.cd-ef' apikey:x", "K" * 3 + "İtoken=123456"])
def test_patterns_on_corner_cases(text):
    kinds = secret_cnn.KINDS
    assert [(s.start, kinds.index(s.kind), s.end) for s in secret_cnn.find(text)[0]] == brute_spans(text)


def labelled_texts(n, seed):
    r = random.Random(seed)
    texts = []
    for i in range(n):
        secret = "".join(r.choice("0123456789abcdef") for _ in range(40))
        card = "".join(r.choice("0123456789") for _ in range(16))
        texts.append(prose(i, 5) + (f' token = "{secret}" ' if i % 2 else f" call {card} now ") + prose(i + 7, 5))
    return texts


def planted(n, seed, texts):
    """Texts with a secret each that no pattern takes: other separators, alphabets and telling words than theirs."""
    r = random.Random(seed)
    figures, letters = string.digits, string.ascii_letters
    for _ in range(n):
        value = r.choice([
            "".join(r.choices(letters + figures, k=r.randint(16, 40))), "".join(r.choices(letters, k=r.randint(14, 30))),
            "".join(r.choices(string.ascii_uppercase + figures, k=20)), r.choice(["hunter", "winter"]) + f"{r.randint(10, 99)}x"])
        lead = r.choice(["pwd ", "Bearer ", "key: ", "passphrase ", "auth token ", "login ", "token == "])
        yield f"{r.choice(texts)[:300]} {lead}{value} {r.choice(texts)[:60]}", value


def test_network_finds_what_no_pattern_takes(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    net = secret_cnn.fit(docs.where("doc_id % 2 = 0"))
    held_out = [r.text or "" for r in docs.where("doc_id % 2 = 1").collect()]
    base, every = secret_cnn.spans_of(held_out, net)
    assert sum(len(e) > len(b) for b, e in zip(base, every, strict=True)) <= 0.01 * len(held_out)
    hidden = list(planted(200, 5, [t for t in texts if t]))
    hidden.append(("he said key: QwErTyUiOpAsDfGhJkLz and pwd hunter2x", "QwErTyUiOpAsDfGhJkLz"))
    base, every = secret_cnn.spans_of([t for t, _ in hidden], net)
    met = [any(t[s.start:s.end] in v or v in t[s.start:s.end] for s in spans) for (t, v), spans in zip(hidden, every, strict=True)]
    by_pattern = [any(v in t[s.start:s.end] for s in spans) for (t, v), spans in zip(hidden, base, strict=True)]
    assert sum(by_pattern) < 20 and sum(met) >= 0.9 * len(hidden)
    assert all(set(b) <= set(e) for b, e in zip(base, every, strict=True))


def test_covered_is_any_overlap_and_long_texts_are_linear():
    r = random.Random(2)
    spans = secret_cnn.in_order([secret_cnn.Span("hex", a, a + r.randint(1, 30)) for a in r.sample(range(500), 40)])
    candidates = [(a, a + r.randint(1, 20)) for a in range(0, 520, 3)]
    assert secret_cnn.covered(candidates, spans) == [any(a < s.end and s.start < z for s in spans) for a, z in candidates]
    text, start = ("0123456789abcdef" * 2 + " ") * 30_000, time.process_time()
    assert len(secret_cnn.spans_of([text], None)[0][0]) == 30_000
    spans, candidates = secret_cnn.find(text)
    assert all(secret_cnn.covered(candidates, spans)) and time.process_time() - start < 10


def test_made_up_windows_show_both_ends():
    w = secret_cnn.window("ab " + "x" * 100 + "END now", 3, 106)
    assert len(w) == secret_cnn.WIDTH and b"END" in w and w.endswith(b" now" + bytes(secret_cnn.AFTER - 4))


def test_gradients():
    net = secret_cnn.CharCnn(dims=3, filters=2)
    r = np.random.default_rng(0)
    codes = r.integers(0, 128, (6, secret_cnn.WIDTH)).astype(np.uint8)
    labels, weight = np.array([0, 1, 0, 1, 1, 0]), np.ones(6)

    def loss():
        z = net._forward(codes)[3]
        return float(np.mean(np.log1p(np.exp(z)) - labels * z))

    for name, g in net._gradients(codes, labels, weight).items():
        flat = net.p[name].reshape(-1)
        for at in r.choice(len(flat), min(6, len(flat)), replace=False):
            if name == "vector" and at < 3:
                continue  # the vector of the padding stays zero
            old = flat[at]
            flat[at] = old + 1e-6
            up = loss()
            flat[at] = old - 1e-6
            down = loss()
            flat[at] = old
            assert g.reshape(-1)[at] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_redaction(odd, none):
    with pytest.warns(UserWarning, match="network is off"):
        assert secret_cnn.fit(none) is None
    assert secret_cnn.scan(odd, secret_cnn.fit(odd)).count() == odd.count()
    rows = secret_cnn.redact(odd, None)
    assert rows.columns == odd.columns
    assert sorted(r.text or "" for r in rows.collect()) == sorted(
        "[secret]\"" if (r.text or "").startswith("token") else r.text or "" for r in odd.collect())
    assert secret_cnn.scan(none, None).count() == 0 and secret_cnn.scan(odd, None).count() == odd.count()
    spans = [secret_cnn.Span("assign", 2, 6), secret_cnn.Span("hex", 4, 9), secret_cnn.Span("hex", 9, 10)]
    assert secret_cnn.redacted("ab0123456789", spans, "*") == "ab**89"


# Toxicity


@pytest.fixture(scope="module")
def letters(spark):
    words = "idiot moron loser worthless pathetic trash stupid clown the and people say that this is a".split()
    r = random.Random(5)
    texts = [" ".join(r.choice(words) for _ in range(40)) for _ in range(50)]
    return toxicity.character_model(spark.createDataFrame([(t,) for t in texts], "text string"))


@pytest.mark.parametrize("written, meant", [
    ("1d10t", ["idiot"]), ("i d i o t", ["idiot"]), ("idiooooot", ["idiot"]), ("w0rthl3ss", ["worthless"]),
    ("p@thet1c", ["pathetic"]), ("m.o.r.o.n", ["moron"]), ("tr@$h", ["trash"]), ("$tup1d", ["stupid"]), ("cl0wn!!", ["clown"]),
    ("people", ["people"]), ("THE,", ["the"]), ("42", []), ("", []), ("***", [])])
def test_disguises_are_restored(letters, written, meant):
    assert toxicity.Restorer(letters).words(written) == meant


def test_disguise_at_the_end_and_words_without_letters():
    texts = ["you idiot and shit basta class glass mass pass grass idiots shits so it stops in the house win"] * 50
    words = toxicity.Restorer(toxicity.CharacterModel(*toxicity._trigram_counts(texts))).words
    assert words("idio+ bas+@ gla$$ 1d10+! $h!7 455 5h17") == ["idiot", "basta", "glass", "idiot", "shit", "ass", "shit"]
    assert words("house! stops!! win!!! house$$$ 2024 555 +1 $5 | !!!") == ["house", "stops", "win", "house"]


def brute_decode(word, model):
    """All readings of the lattice, scored one by one."""
    best = (-1e300, "")

    def walk(slots, at, text, b, l, s):
        nonlocal best
        if at == len(slots):
            if s > best[0] + 1e-12:
                best = (s, text)
            return
        for part, cost in slots[at]:
            b2, l2, s2 = b, l, s + cost
            for c in part:
                code = 0 if c == " " else toxicity._code_of(c)
                if code or l2:
                    s2 += model.log(b2, l2, code)
                    b2, l2 = l2, code
            walk(slots, at + 1, text + part, b2, l2, s2)

    walk([*toxicity.lattice(word), [(" ", 0.0)]], 0, "", 0, 0, 0.0)
    return best[1]


@pytest.mark.parametrize("word", ["1d10t", "tr@$h", "aaab11c", "i d o", "s.t.u", "0", "pe0ple"])
def test_viterbi_finds_the_best_reading(letters, word):
    assert toxicity.viterbi(word, letters) == brute_decode(word, letters)


def test_character_counts_equal_brute_force(spark):
    texts = ["Ab c!", None, "", "éÉ 你a1b"]
    got = {r.code: r.n for r in toxicity.character_counts(spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    a, want = toxicity.ALPHABET, Counter()
    for t in texts:
        codes = [0]
        for c in (t or "") + "\n":
            code = toxicity._code_of(c.lower()) if c.isalpha() else 0
            if code or codes[-1]:
                codes.append(code)
        want.update((x * a + y) * a + z for x, y, z in zip(codes, codes[1:], codes[2:], strict=False))
    assert got == want


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = REGISTRY["op3_toxicity"](spark, sf).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    judged = [(labels[r.doc_id], r.predicted, r.score) for r in rows if r.held_out and r.doc_id in labels]
    bad, good = [x for x in judged if x[0]], [x for x in judged if not x[0]]
    assert sum(p for _, p, _ in good) <= 0.02 * len(good)
    above = sum((s > t) + (s == t) / 2 for _, _, s in bad for _, _, t in good) / (len(bad) * len(good))
    assert above > 0.85


def test_toxicity_odd_rows(spark, odd, none):
    letters = toxicity.character_model(odd)
    labels = toxicity.training_labels(spark.createDataFrame(
        [(1, 0), (2, 1), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int"))
    assert {(r.doc_id, r.toxic) for r in labels.collect()} <= {(1, 0), (2, 1)}
    assert toxicity.fit(none, labels, letters) is None
    rows = toxicity.score(odd, letters, None).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {0.0}
    assert toxicity.keep_civil(odd, letters, None).columns == odd.columns
    assert toxicity.score(none, toxicity.character_model(none), None).count() == 0


def test_calibration_takes_all_held_out_windows(spark):
    """Each distinct held-out window counts, however few are drawn for training, and the threshold keeps the recall."""
    texts = [f"row {i} password = {hashlib.md5(str(i).encode()).hexdigest()[:14]} and part {i * 7919:012d}abcdef{i:06d} end" for i in range(900)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, *texts[:50]])], "doc_id long, text string").repartition(3)
    net = secret_cnn.fit(docs, sample_findings=60, sample_others=60, sample_places=20)
    want = {0: set(), 1: set()}
    for t in texts:
        spans, candidates = secret_cnn.find(t)
        for c, kind in zip(candidates, secret_cnn.covered(candidates, spans), strict=True):
            w = secret_cnn.window(t, *c)
            if secret_cnn._held(hashlib.md5(w).hexdigest()):
                want[int(kind)].add(w)
    rows = secret_cnn._held_out(docs, net).collect()
    assert {k: sum(r["n"] for r in rows if r["kind"] == k) for k in want} == {k: len(v) for k, v in want.items()}
    z, labels, weight = np.array([3.0, 2.0, 1.0, -4.0]), np.array([1, 1, 1, 0]), np.array([90.0, 8.0, 2.0, 50.0])
    for recall, least in ((0.9, 3.0), (0.97, 2.0), (0.99, 1.0)):
        net.calibrate(z, labels, weight, recall)
        assert net.threshold == pytest.approx(1 / (1 + np.exp(-(net.scale * least + net.offset))))
