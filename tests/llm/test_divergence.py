"""The source divergence audit against brute force, and on awkward tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import DOCS, SCHEMA, awkward, empty, many

from shelfwise.llm import divergence

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=3, top=200):
    counts, spread, out = defaultdict(Counter), defaultdict(Counter), []
    for lang, source, text in rows:
        terms = TERM.findall(lower(text or ""))
        counts[lang or "", source or ""].update(terms)
        spread[lang or ""].update(set(terms))
    for lang in spread:
        kept = [t for t, n in spread[lang].items() if n >= least]
        own = {s: {t: c[t] for t in kept} for (x, s), c in counts.items() if x == lang}
        whole = {t: sum(c[t] for c in own.values()) for t in kept}

        def share(table):
            total = sum(table.values()) + len(kept)
            return {t: 1 + 10**9 * (n + 1) // total for t, n in table.items()}

        shares, q = {s: share(c) for s, c in own.items()}, share(whole)
        for s, p in shares.items():
            pairs = sorted((-sum((p[t] - o[t]) ** 2 // o[t] for t in kept), z.encode(), z) for z, o in shares.items() if z != s)
            terms = sorted((-((p[t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in kept if own[s][t] and p[t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item, -v, k) for k, (v, _, item) in enumerate(found, 1)]
    return out


def test_runs_decode_to_the_column():
    rng = np.random.default_rng(3)
    for density in (0, 0.01, 0.4, 1):
        column = np.where(rng.random(500) < density, rng.integers(1, 4, 500), 0)
        places = np.flatnonzero(column)
        starts, values = divergence.encode_runs(places, column[places])
        assert starts[0] == 0 and (values[1:] != values[:-1]).all()
        assert (values[np.searchsorted(starts, np.arange(500), side="right") - 1] == column).all()


def test_run_divergence_of_columns():
    rng = np.random.default_rng(4)
    p, q = (np.sort(rng.integers(1, 9, 300)) for _ in range(2))
    sides = [(s := np.flatnonzero(np.append(True, c[1:] != c[:-1])), c[s]) for c in (p, q)]
    assert divergence.run_divergence(*sides, 300) == (((p - q) ** 2 // q).sum(), ((p - q) ** 2 // p).sum())


@pytest.mark.parametrize("chunk, block", [(1 << 16, 64), (7, 2)])
def test_equals_brute_force(spark, chunk, block, monkeypatch):
    monkeypatch.setattr(divergence, "CHUNK", chunk)
    monkeypatch.setattr(divergence, "BLOCK", block)
    rng = np.random.default_rng(9)
    words = [*(f"w{chr(97 + k)}" for k in range(26)), "Éa", "straße", "漢字", "İ"]
    rows = [
        (("en", "de", None)[rng.integers(3)], (*"abcdefg", None)[min(rng.integers(14), 7)], " ".join(rng.choice(words, rng.integers(0, 30))))
        for _ in range(300)
    ] + [("xx", "lonely", "one two"), ("yy", "a", "no shared"), ("yy", "b", None), ("en", "wordless", "12 34")]
    docs = spark.createDataFrame([(k, t, lang, s, 0) for k, (lang, s, t) in enumerate(rows)], SCHEMA)
    assert many(divergence.divergence(docs).collect()) == many(brute(rows))


def test_awkward(spark):
    rows = [(lang, source, text) for _, text, lang, source, _ in DOCS]
    assert many(divergence.divergence(awkward(spark)).collect()) == many(brute(rows))
    assert divergence.divergence(empty(spark)).count() == 0


def test_large_counts_stay_exact():
    assert divergence.share(10**15, 3 * 10**15, 5) == 1 + 10**9 * (10**15 + 1) // (3 * 10**15 + 5)
