"""Collocations against brute force, on collisions, long texts, repeated ids and awkward tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from edge import DOCS, SCHEMA, awkward, empty, many

from shelfwise.llm import collocations


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=10, longest=3, top=2000):
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, counts in f.items():
        found = []
        several = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in several.items():
            score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            if not any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in several.items()):
                found.append((-score, -a, " ".join(p).encode(), " ".join(p), left, right))
        out += [(lang, k, p, -a, x, y, n[lang], -s) for k, (s, a, _, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return out


def table(spark, rows):
    return spark.createDataFrame([(k, t, lang, "s", 0) for k, (lang, t) in enumerate(rows)], SCHEMA)


def random_rows(seed, n=200):
    rng = np.random.default_rng(seed)
    words = ["a", "b", "B", "Éé", "d-d", "漢", "x1", "#", "e"]
    gaps = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "?! "]
    return [(("en", "de", None)[rng.integers(3)], "".join(w + g for w, g in zip(rng.choice(words, 40), rng.choice(gaps, 40)))) for _ in range(n)]


def test_equals_brute_force(spark):
    rows = random_rows(1) + [("en", "rare words " * 9), ("en", None), ("fr", "twice the same " * 30)]
    assert many(collocations.collocations(table(spark, rows)).collect()) == many(brute(rows))


def test_longer_phrases_and_other_bounds(spark):
    rows = random_rows(2, 60)
    found = collocations.collocations(table(spark, rows), least=4, longest=4, top=7)
    assert many(found.collect()) == many(brute(rows, 4, 4, 7))


def test_collisions_of_prints_are_kept_apart():
    first, second = collocations._polynomials()
    first.runs = lambda words, langs, starts, size: np.full(len(starts), 7 << 60, np.uint64)
    block = collocations.Block(first, second)
    block.add(b"a b a b c", np.array([5]), np.array([0], np.uint64), np.array([0]), True)
    found = {size: sorted(counts.tolist()) for size, _, _, counts, _ in block.entries(3)}
    assert found == {1: [1, 2, 2], 2: [1, 1, 2], 3: [1, 1, 1]}


def thue_morse(n):
    """Two different words whose polynomials agree modulo 2**64 at every odd base."""
    first = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
    return first, first.translate({97: "b", 98: "a"})


def test_thue_morse_words_have_one_hash():
    first, second = (np.frombuffer(w.encode(), np.uint8) for w in thue_morse(1024))
    for p in collocations._polynomials():
        hashes = [p.slices(p.of_byte[w], np.array([0]), np.array([1024]))[0] for w in (first, second)]
        assert hashes[0] == hashes[1]


@pytest.mark.parametrize("often, tasks", [((6, 7), 1), ((12, 15), 1), ((12, 15), 5), ((3, 25), 4), ((9, 9), 9)])
def test_runs_with_equal_fingerprints_are_compared(spark, often, tasks):
    """Both words and all runs with them collide in all 80 bits, in one block and between blocks."""
    rows = random_rows(5, 40)
    for word, n in zip(thue_morse(1024), often, strict=True):
        rows += [("en", f"x {word} of y, {word}  of\tz")] * n
    found = collocations.collocations(table(spark, rows).repartition(tasks)).collect()
    assert many(found) == many(brute(rows))


def test_everything_collides(monkeypatch):
    """All runs of all sizes and languages have one fingerprint and one check; the texts alone tell them apart."""
    rows = random_rows(7, 30)
    for name in ("slices", "runs"):
        monkeypatch.setattr(collocations.Polynomial, name, lambda self, values, a, b, c=0: np.zeros(len(b), np.uint64))
    monkeypatch.setattr(collocations, "BLOCK_WORDS", 150)
    batch = pa.RecordBatch.from_arrays([pa.array([lang or "und" for lang, _ in rows]), pa.array([t.encode() for _, t in rows])], ["lang", "text"])
    blocks = [b.append_column("block", pa.array([k])) for k, b in enumerate(collocations._pack([batch]))]
    sent = pa.Table.from_batches(collocations._send(3, 3)(blocks))
    replies = collocations._add_up(10)(sent)
    spelled = [collocations._spell(3, 1, 3)(pa.Table.from_batches([b]), replies.filter(pc.equal(replies["block"], k))) for k, b in enumerate(blocks)]
    found = collocations._count(10)(pa.concat_tables(spelled)).to_pylist()
    counts = Counter((lang or "und", " ".join(words[i : i + k])) for lang, t in rows for piece in re.split(r"[.,;:!?\n]", lower(t))
                     for words in [piece.split()] for k in (1, 2, 3) for i in range(len(words) - k + 1))
    assert len(blocks) > 4
    assert {(r["lang"], r["phrase"].decode()): r["total"] for r in found} == {p: a for p, a in counts.items() if a >= 10}


def test_strips_give_the_words_of_the_whole(monkeypatch):
    monkeypatch.setattr(collocations, "STRIP", 16)
    rng = np.random.default_rng(3)
    text = "".join(rng.choice([*"abcde .,\n", "averyveryverylongword"], 400)).encode()
    whole, cut = (collocations.Block(*collocations._polynomials()) for _ in range(2))
    args = np.array([1]), np.array([9], np.uint64), np.array([0])
    whole.add(text, *args, True)
    broken = True
    parts = list(collocations.strips(text))
    assert b"".join(parts) == text and len(parts) > 20
    for part in parts:
        broken = cut.add(part, *args, broken)
    for a, b in zip(whole.entries(3), cut.entries(3), strict=True):
        for x, y in zip(a, b, strict=True):
            assert np.array_equal(x, y)


def test_overlapping_strips_hold_every_run(monkeypatch):
    monkeypatch.setattr(collocations, "STRIP", 12)
    words = [f"w{k}" for k in range(60)]
    parts = [p.split() for p in collocations._overlapping(" ".join(words).encode(), 3)]
    runs = {tuple(p[i : i + 3]) for p in parts for i in range(len(p) - 2)}
    assert runs == {tuple(w.encode() for w in words[i : i + 3]) for i in range(58)}


def test_long_texts(spark):
    rng = np.random.default_rng(6)
    rows = [("en", " ".join(rng.choice(["ab", "cde", "f,", "ghij"], 300_000))), ("en", "x " * 300_000)]
    assert many(collocations.collocations(table(spark, rows)).collect()) == many(brute(rows))


def test_repeated_and_missing_ids(spark):
    rows = random_rows(4, 90)
    docs = spark.createDataFrame([((None, 1, k)[k % 3], t, lang, "s", 0) for k, (lang, t) in enumerate(rows)], SCHEMA)
    assert many(collocations.collocations(docs).collect()) == many(brute(rows))


@pytest.mark.parametrize("least", [1, 10])
def test_awkward(spark, least):
    rows = [(lang, text) for _, text, lang, _, _ in DOCS]
    assert many(collocations.collocations(awkward(spark), least=least).collect()) == many(brute(rows, least))
    assert collocations.collocations(empty(spark)).count() == 0
