"""Operators against brute force on small tables, including one user or item holding a third of all rows."""

import itertools
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfwise.functions.arrays import cosine, dot
from shelfwise.operators import blocks, factor, ids, krylov, models, neighbours, recommend, relational as rel, similarity as sim

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def skewed(seed=7, users=30, items=60, rows=900):
    """Distinct pairs; user 3 holds a third of the rows' worth of items and item 5 is very common."""
    rng = random.Random(seed)
    pairs = {(3, i) for i in range(items)}
    pairs |= {(u, 5) for u in range(users)}
    while len(pairs) < min(rows, users * items // 3):
        pairs.add((rng.randrange(users), rng.randrange(items)))
    return sorted(pairs)


@pytest.fixture(scope="module")
def pairs():
    return skewed()


@pytest.fixture(params=[100_000, 3], ids=["few", "many"])
def side(request, monkeypatch):
    """Side inputs once as small local tables and once beyond the bound."""
    monkeypatch.setattr(rel, "FEW", request.param)


@pytest.fixture(scope="module")
def table(spark, pairs):
    return spark.createDataFrame(pairs, "u long, i long").repartition(5)


def sets_of(pairs, by=0):
    held = defaultdict(set)
    for row in pairs:
        held[row[by]].add(row[1 - by])
    return held


def test_copurchase(table, pairs, side):
    held = sets_of(pairs)
    want = sorted(((u, len(held[u] & held[8])) for u in held if u != 8), key=lambda x: (-x[1], x[0]))[:10]
    assert [tuple(r) for r in recommend.copurchase_users(table, 8).collect()] == [x for x in want if x[1]]


@pytest.mark.parametrize("target", [3, 8])
def test_shared_sets(table, pairs, target, side):
    held = sets_of(pairs)
    for r in sim.shared_with_target(table, target).collect():
        assert (r["n_items"], r["n_shared"], r["n_target"]) == (len(held[r["u"]]), len(held[r["u"]] & held[target]), len(held[target]))


@pytest.mark.parametrize("target", [3, 8])
def test_mean_item_cosine(table, pairs, target, side):
    held, buyers = sets_of(pairs), sets_of(pairs, 1)
    mine = held[target]
    want = {
        i: sum(len(buyers[i] & buyers[j]) / math.sqrt(len(buyers[i]) * len(buyers[j])) for j in mine) / len(mine)
        for i in buyers if i not in mine
    }
    got = {r["i"]: r["score"] for r in sim.mean_item_cosine(table, target).collect()}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("per_slice", [3, 100_000])
@pytest.mark.parametrize("target", [3, 8])
def test_item_cosine(table, pairs, target, per_slice, side):
    held, buyers = sets_of(pairs), sets_of(pairs, 1)
    want = {
        (a, b): len(buyers[a] & buyers[b]) / math.sqrt(len(buyers[a]) * len(buyers[b]))
        for a in held[target] for b in buyers if a != b and buyers[a] & buyers[b]
    }
    got = {(r["a"], r["b"]): r["score"] for r in sim.item_cosine(table, rel.items_of(table, target), per_slice).collect()}
    assert got == pytest.approx(want)


def test_neighbourhood(spark, pairs, side):
    rng = random.Random(1)
    w = {p: float(rng.randint(1, 9)) for p in pairs}
    weighted = spark.createDataFrame([(u, i, x) for (u, i), x in w.items()], "u long, i long, w double")
    held, buyers = sets_of(pairs), sets_of(pairs, 1)
    want = {}
    for i in set(buyers) - held[8]:
        sims = []
        for j in held[8]:
            both = buyers[i] & buyers[j]
            if both:
                a, b = np.array([w[u, i] for u in both]), np.array([w[u, j] for u in both])
                sims.append(0.5 * a @ b / np.linalg.norm(a) / np.linalg.norm(b))
        if sims:
            want[i] = np.mean(sims)
    got = {r["item_id"]: r["score"] for r in recommend.neighbourhood_scores(weighted, 8).collect()}
    assert got == pytest.approx(want, abs=1e-6)


def test_content_top(spark, table, pairs, side):
    rng = np.random.default_rng(0)
    vec = {i: rng.random(4) for i in range(60)}
    features = spark.createDataFrame([(i, p, float(x)) for i, v in vec.items() for p, x in enumerate(v)], "i long, pos long, value double")
    held = sets_of(pairs)
    near = [u for u, _ in sorted(((u, len(held[u] & held[8])) for u in held if u != 8), key=lambda x: (-x[1], x[0]))[:2]]
    candidates = set().union(*(held[u] for u in near)) - held[8]
    cos = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    want = sorted(((round(np.mean([cos(vec[c], vec[m]) for m in held[8]]), 6), c) for c in candidates), key=lambda x: (-x[0], x[1]))[:5]
    got = recommend.content_top(table, features, 8, peers=2).collect()
    assert [(r["rank"], r["item_id"]) for r in got] == [(n + 1, c) for n, (_, c) in enumerate(want)]
    assert [r["score"] for r in got] == pytest.approx([s for s, _ in want], abs=2e-6)


def test_zero_vectors_are_left_out(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 1.0])], "i long, v array<double>")
    scored = sim.mean_cosine(df, df.where("i < 3"), "v").collect()
    assert {r["i"]: round(r["score"], 6) for r in scored} == {1: 1.0, 3: round(1 / math.sqrt(2), 6)}


def test_sets_and_lists_are_whole(spark):
    lines = [(1, i) for i in range(50)] * 3 + [(2, 49), (2, 0)]
    df = spark.createDataFrame(lines, "u long, i long")
    sets = rel.item_sets(df, chunk=16).collect()
    assert max(len(r["items"]) for r in sets) == 16 and len(sets) == 6
    got = rel.explode_items(rel.item_sets(df, chunk=16))
    assert {tuple(r) for r in got.collect()} == set(lines) and got.count() == len(set(lines))
    counted = {(r["u"], e["i"]): e["n"] for r in rel.item_lists(df, chunk=16).collect() for e in r["items"]}
    assert counted == Counter(lines)


def test_top_k_per_group(table, pairs):
    got = rel.top_k_per_group(table, "u", 3, F.desc("i")).collect()
    held = sets_of(pairs)
    assert {(r["u"], r["rank"]): r["i"] for r in got} == {
        (u, n + 1): i for u in held for n, i in enumerate(sorted(held[u], reverse=True)[:3])
    }


@FEW
@given(st.lists(st.integers(-(2**40), 2**40), min_size=0, max_size=60), st.integers(1, 6))
def test_dense_index_equals_dense_rank(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "k long").repartition(parts)
    want = {v: n for n, v in enumerate(sorted(set(values)))}
    assert {r["k"]: r["ix"] for r in ids.dense_index(df, "k", "ix").collect()} == want


def test_dense_index_of_text(spark):
    df = spark.createDataFrame([(s,) for s in "delta alpha charlie bravo alpha".split()], "k string")
    assert {r["k"]: r["ix"] for r in ids.dense_index(df, "k", "ix").collect()} == {"alpha": 0, "bravo": 1, "charlie": 2, "delta": 3}


@FEW
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 5)), min_size=1, max_size=25, unique=True))
def test_sparse_cosine_equals_dense_cosine(spark, rows):
    users = sorted({u for u, _ in rows})
    df = spark.createDataFrame(rows, "u long, i long")
    dense = spark.createDataFrame(
        [(i, [1.0 if (u, i) in set(rows) else 0.0 for u in users]) for i in sorted({i for _, i in rows})], "i long, v array<double>"
    )
    a, b = dense.select(F.col("i").alias("a"), F.col("v").alias("va")), dense.select(F.col("i").alias("b"), F.col("v").alias("vb"))
    want = {(r["a"], r["b"]): r["s"] for r in a.join(b, F.col("a") != F.col("b")).withColumn("s", cosine(F.col("va"), F.col("vb"))).collect() if r["s"]}
    got = {(r["a"], r["b"]): r["score"] for r in sim.item_cosine(df, df.select("i").distinct()).collect()}
    assert got == pytest.approx(want)


def matrix_of(pairs):
    rows, cols = sorted({p[0] for p in pairs}), sorted({p[1] for p in pairs})
    m = np.zeros((len(rows), len(cols)))
    for u, i in pairs:
        m[rows.index(u), cols.index(i)] = 1.0
    return m, rows, cols


def cosines(rows):
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    return unit @ unit.T


@pytest.mark.parametrize("tile, width, kept", [(1 << 18, 48, 24), (40, 6, 24), (40, 5, 3)])
def test_svd_agrees_with_numpy(spark, table, pairs, tile, width, kept, monkeypatch):
    """In one tile and in many, in one step and in many, with restarts; the rest of the work is the same at all widths."""
    for name, value in (("TILE", tile), ("WIDTH", width), ("KEPT", kept)):
        monkeypatch.setattr(krylov, name, value)
    m, rows, cols = matrix_of(pairs)
    u, s, vt = np.linalg.svd(m)
    found = factor.pair_svd(table.select(F.col("u").alias("row"), F.col("i").alias("col")), 4)
    assert found.s == pytest.approx(s[:4], rel=1e-9)
    got = {r["row"]: r["v"] for r in found.rows.collect()}
    ours, theirs = np.array([got[x] for x in rows]), u[:, :4] * s[:4]
    assert np.allclose(np.abs(ours), np.abs(theirs), atol=1e-5)
    got = {r["col"]: r["v"] for r in found.columns.collect()}
    low_rank = theirs @ vt[:4]
    assert np.allclose(cosines(np.array([got[x] for x in cols])), cosines(low_rank.T), atol=1e-5)


def test_svd_passes_on_tile_by_tile(spark, pairs, monkeypatch):
    """The sums of one tile leave before the next tile is read, and a thin table's row costs one sum, not one for each entry."""
    monkeypatch.setattr(krylov, "TILE", 40)
    df = spark.createDataFrame(pairs, "row long, col long").withColumn("w", F.lit(1.0))
    tiles = krylov._tiles(df, "col", "row", 1, 7).tiles.toArrow()
    assert tiles.num_rows > 4
    keys = np.array(sorted({c for _, c in pairs}))
    factor_block = np.ones((len(keys), 2)).tobytes()
    joined = krylov.pa.table({**{c: tiles[c] for c in tiles.column_names}, "fkeys": [keys.tobytes()] * tiles.num_rows, "f": [factor_block] * tiles.num_rows})
    read = []

    def batches():
        for batch in joined.combine_chunks().to_batches(max_chunksize=2):
            read.append(batch.num_rows)
            yield batch

    made = krylov._times(batches())
    sent = [next(made)]
    assert sum(read) <= 2 and len(set(sent[0]["block"].to_pylist())) == sent[0].num_rows
    sent += made
    assert sum(len(krylov._keys(k)) for b in sent for k in b["keys"].to_pylist()) == len({u for u, _ in pairs})


@pytest.mark.parametrize("hot", [8, 0, 0.2])
def test_svd_in_strips(spark, table, pairs, hot, monkeypatch):
    """Many strips, with no, all and some rows too large for them; entries are laid out once, and no sum of an entry is shuffled."""
    for name, value in (("TILE", 40), ("KEYS", 4), ("STRIP", 2), ("HOT", hot)):
        monkeypatch.setattr(krylov, name, value)
    laid = []
    monkeypatch.setattr(krylov, "_tiles", lambda *a, f=krylov._tiles: laid.append(a) or f(*a))
    m, rows, cols = matrix_of(pairs)
    found = factor.pair_svd(table.select(F.col("u").alias("row"), F.col("i").alias("col")), 4)
    _, s, vt = np.linalg.svd(m)
    assert found.s == pytest.approx(s[:4], rel=1e-9) and len(laid) == (0 if hot == 8 else 2)
    for side, keys, whole in ((found.rows, rows, m @ vt[:4].T), (found.columns, cols, vt[:4].T * s[:4])):
        got = {r[0]: r[1] for r in side.collect()}
        assert np.allclose(np.abs([got[x] for x in keys]), np.abs(whole), atol=1e-4) and len(got) == len(keys)


def test_svd_in_blocks_of_few_keys(spark, table, pairs, monkeypatch):
    monkeypatch.setattr(krylov, "TILE", 40)
    monkeypatch.setattr(krylov, "KEYS", 4)
    found = factor.pair_svd(table.select(F.col("u").alias("row"), F.col("i").alias("col")), 4)
    assert found.s == pytest.approx(np.linalg.svd(matrix_of(pairs)[0])[1][:4], rel=1e-9)


def test_svd_of_close_values(spark):
    rng = np.random.default_rng(8)
    left, right = (np.linalg.qr(rng.normal(size=(n, 40)))[0] for n in (90, 70))
    s = 1 - 1e-3 * np.arange(40)
    m = (left * s) @ right.T
    df = spark.createDataFrame([(i, j, float(m[i, j])) for i in range(90) for j in range(70)], "row long, col long, w double")
    found = krylov.table_svd(df, 6)
    assert found.s == pytest.approx(s[:6], rel=1e-9)
    v = np.array([r["v"] for r in found.vectors.orderBy("col").collect()])
    assert np.allclose(v.T @ v, np.eye(6), atol=1e-8) and np.allclose(np.abs(v), np.abs(right[:, :6]), atol=1e-4)


def test_svd_of_low_rank_and_nothing(spark):
    df = spark.createDataFrame([(i, j, float(i * j)) for i in range(1, 9) for j in range(1, 6)] + [(1, 1, 0.0)], "row long, col long, w double")
    assert krylov.table_svd(df, 3).s == pytest.approx([np.sqrt(204 * 55)])
    nothing = krylov.table_svd(df.where("row < 0"), 3)
    assert len(nothing.s) == 0 and nothing.rows.count() == 0


def test_pca_centres_a_sparse_table(spark):
    rng = np.random.default_rng(9)
    m = np.where(rng.random((60, 12)) < 0.3, rng.integers(1, 9, (60, 12)), 0).astype(float)
    df = spark.createDataFrame([(k, Vectors.dense(r.tolist())) for k, r in enumerate(m)], ["id", "v"])
    projected, shares = factor.pca(df, "id", "v", 4)
    _, s, vt = np.linalg.svd(m - m.mean(axis=0))
    assert shares == pytest.approx(s[:4] ** 2 / (s**2).sum(), rel=1e-9)
    got = np.array([r["components"].toArray() for r in projected.orderBy("id").collect()])
    assert np.allclose(np.abs(got), np.abs(m @ vt[:4].T), atol=1e-5)


@pytest.mark.parametrize("heavy, k", [(1000, 3), (6, 3), (0, 4), (6, 40)])
def test_item_neighbours(spark, heavy, k):
    """Users lighter and heavier than the bound, one of whom holds a third of all pairs, against all pairs."""
    draw = random.Random(4)
    pairs = {(u, draw.randrange(60)) for u in range(40) for _ in range(draw.randint(1, 9))} | {(99, i) for i in range(0, 150)} | {(98, i) for i in range(100, 130)}
    users = defaultdict(set)
    for u, i in pairs:
        users[i].add(u)
    want = []
    for a in users:
        scored = sorted((-len(users[a] & users[b]) / math.sqrt(len(users[a]) * len(users[b])), b) for b in users if a != b and users[a] & users[b])
        want += [(a, n, b, pytest.approx(-s)) for n, (s, b) in enumerate(scored[:k], 1)]
    df = spark.createDataFrame(sorted(pairs) + sorted(pairs)[:5], "u long, i long")
    found = neighbours.item_neighbours(df, k, heavy).orderBy("a", "rank").collect()
    assert [tuple(r) for r in found] == sorted(want, key=lambda r: (r[0], r[1]))


def test_bayes_prediction_ties_and_unknown_terms(spark):
    counts = spark.createDataFrame([(1, "x", 2), (2, "y", 1), (3, "x", 1), (3, "y", 1), (4, "z", 5), (6, "y", 3)], "doc_id long, term string, n long")
    train = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, label long")
    table = models.bayes_log_probabilities(counts, train, "doc_id", [0, 1])
    test = spark.createDataFrame([(3, 1), (4, 1), (5, 0), (6, 1)], "doc_id long, label long")
    rows = models.bayes_predict(counts, test, table, models.log_priors(train, [0, 1]), "doc_id")
    x, y = {0: math.log(3 / 4), 1: math.log(1 / 3)}, {0: math.log(1 / 4), 1: math.log(2 / 3)}
    both = int(x[1] + y[1] > x[0] + y[0])
    assert sorted(map(tuple, rows.collect())) == [(3, 1, both), (4, 1, 0), (5, 0, 0), (6, 1, 1)]
    assert models.log_priors(train.where("label = 0"), [0, 1]) == {0: 0.0, 1: -math.inf}


def test_energy_rank():
    s = np.array([3.0, 2.0, 1.0])
    assert factor.rank_for(s, 14.0, 0.9) == 2
    assert factor.rank_for(s, 14.0, 0.95) == 3
    assert factor.rank_for(s[:1], 14.0, 0.95) is None


@pytest.mark.parametrize("block, strip", [(4096, 512), (7, 3)])
def test_unseen_top(spark, table, pairs, block, strip, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", block)
    monkeypatch.setattr(blocks, "STRIP", strip)
    rng = np.random.default_rng(5)
    users, items = {u: rng.normal(size=3) for u in range(30)}, {i: rng.normal(size=3) for i in range(60)}
    users[4] = np.zeros(3)

    def frame(rows, key):
        return spark.createDataFrame([(k, v.tolist()) for k, v in rows.items()], f"{key} long, v array<double>")

    held, want = sets_of(pairs), {}
    for u, x in users.items():
        if not x.any():
            continue
        scored = [(-round(float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), 6), i) for i, y in items.items() if i not in held[u]]
        for n, (s, i) in enumerate(sorted(scored)[:5]):
            want[u, n + 1] = (i, -s)
    got = {(r["user_id"], r["rank"]): (r["item_id"], r["score"]) for r in blocks.unseen_top(frame(users, "u"), frame(items, "i"), table).collect()}
    assert got == want


@pytest.mark.parametrize("n_items, with_seen", [(3000, True), (3000, False), (7, True), (0, False)])
def test_best_items_by_bounds(spark, n_items, with_seen):
    """Clustered factors of very different lengths: the rows of scoring everything, from a fraction of the products."""
    rng = np.random.default_rng(6)
    hubs = rng.normal(size=(12, 6))
    items = (hubs[rng.integers(12, size=n_items)] + 0.1 * rng.normal(size=(n_items, 6))) * np.exp(rng.normal(size=(n_items, 1)))
    users = hubs[rng.integers(12, size=120)] + 0.1 * rng.normal(size=(120, 6))
    users[3] = 0
    if n_items:
        items[5 % n_items] = 0
    seen = [(u, int(i)) for u in range(120) for i in rng.integers(n_items, size=20)] if with_seen else []
    frames = [spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(m)], f"{c} long, v array<double>") for m, c in ((users, "u"), (items, "i"))]
    found, products = blocks.best_items(*frames, 5, spark.createDataFrame(seen, "u long, i long") if with_seen else None)
    scores, want, held = np.round(users @ items.T, 6) + 0.0, [], set(seen)
    for u in range(120):
        best = sorted((-scores[u, i], i) for i in range(n_items) if (u, i) not in held)[:5]
        want += [(u, k, i, -s + 0.0) for k, (s, i) in enumerate(best, 1)]
    assert sorted((r[0], r[1], r[2], r[3] + 0.0) for r in found.collect()) == want
    assert products < 0.5 * 120 * n_items if n_items > 100 else products == 120 * n_items


def test_neighbours_shuffle_lists_and_not_pairs(spark, table, monkeypatch):
    """One shuffle by item serves the counts and the ranks; hot items give the same rows."""
    usual = sorted(neighbours.item_neighbours(table, 5).collect())
    monkeypatch.setattr(neighbours, "HOT", 3)
    assert sorted(neighbours.item_neighbours(table, 5).collect()) == usual
    light = table.select("u", "i").distinct()
    found, _ = neighbours._shared(light, light.groupBy("i").agg(F.count(F.lit(1)).alias("n")), 8)
    plan = rel.top_k_per_group(found, "a", 5, F.asc("b"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(a" in plan and plan.count("Exchange hashpartitioning(a") == 1


def test_best_items_in_strips_and_slices_write_no_visits(spark, monkeypatch):
    """Many strips and slices, equal scores and heavy users; what is written is k rows for each user and slice."""
    written, keep = [], blocks.durable
    monkeypatch.setattr(blocks, "durable", lambda df: written.append(keep(df)) or written[-1])
    monkeypatch.setattr(blocks, "USERS", 60)
    monkeypatch.setattr(blocks, "ITEMS", 700)
    rng = np.random.default_rng(5)
    users, items = rng.normal(size=(200, 4)), np.repeat(rng.normal(size=(1000, 4)), 2, axis=0)
    seen = {(u, int(i)) for u in range(200) for i in rng.integers(2000, size=1500 if u == 7 else 30)}
    frames = [spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(m)], f"{c} long, v array<double>") for m, c in ((users, "u"), (items, "i"))]
    found, _ = blocks.best_items(*frames, 5, spark.createDataFrame(sorted(seen), "u long, i long"))
    scores = np.round(users @ items.T, 6) + 0.0
    want = [(u, k, i, -s) for u in range(200) for k, (s, i) in enumerate(sorted((-scores[u, i], i) for i in range(2000) if (u, i) not in seen)[:5], 1)]
    assert sorted((r[0], r[1], r[2], r[3] + 0.0) for r in found.collect()) == want
    assert sum(df.count() for df in written) <= 200 + 2000 + 5 * 200 * 3 + 48


def test_item_neighbours_in_passes(spark, table, monkeypatch):
    """The lists of some items at a time: what a pass shuffled goes before the next, and the rows are the same."""
    usual, ended = sorted(neighbours.item_neighbours(table, 5).collect()), []
    monkeypatch.setattr(neighbours, "PASS", 1000)
    monkeypatch.setattr(neighbours, "forget", ended.append)
    assert sorted(neighbours.item_neighbours(table, 5).collect()) == usual and len(ended) > 2


def test_neighbouring_terms_in_parts(spark, monkeypatch):
    from shelfwise.operators import text as tx

    monkeypatch.setattr(tx, "PART", 7)
    draw = random.Random(3)
    rows = [[draw.choice("abcde") for _ in range(draw.randint(0, 40))] for _ in range(30)]
    want = Counter((r[i], r[j]) for r in rows for i in range(len(r)) for j in range(len(r)) if i != j and abs(i - j) <= 3)
    df = spark.createDataFrame([(r,) for r in rows], "tokens array<string>")
    assert {(r["a"], r["b"]): r["n"] for r in tx.neighbouring_terms(df, 3).collect()} == dict(want)


def test_neighbouring_terms_shuffle_once(spark):
    from shelfwise.operators import text as tx

    found = tx.neighbouring_terms(spark.createDataFrame([(["a", "b", "a"],)], "tokens array<string>"), 2)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in found.collect()} == {("a", "b", 2), ("b", "a", 2), ("a", "a", 2)}


def test_term_vectors_find_planted_neighbours(spark):
    from shelfwise.operators import text as tx

    rng = np.random.default_rng(2)
    groups = [[f"{g}{k}" for k in range(6)] for g in "xyz"]
    rows = [(k, rng.choice(groups[k % 3], 30).tolist() + ["rare"] * (k == 0)) for k in range(60)] + [(60, []), (61, ["rare"])]
    df = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    v = {r["term"]: np.array(r["v"]) for r in tx.term_vectors(df, 3, least=5).collect()}
    assert set(v) == {t for g in groups for t in g}
    near = {(a, b): float(v[a] @ v[b] / np.linalg.norm(v[a]) / np.linalg.norm(v[b])) for a in v for b in v if a != b}
    assert min(s for (a, b), s in near.items() if a[0] == b[0]) > 0.9 > 0.5 > max(s for (a, b), s in near.items() if a[0] != b[0])
    got = {(r["doc_id"], r["pos"]): r["value"] for r in tx.embed_documents(df, "doc_id", 3, least=5).collect()}
    assert len(got) == 3 * 62 and got[60, 0] == got[61, 2] == 0.0
    assert [got[4, p] for p in range(3)] == pytest.approx(np.mean([v[t] for t in rows[4][1]], axis=0).tolist())


def test_word2vec_keeps_rare_terms(spark, tmp_path):
    """Words that occur once have vectors in the query too."""
    from shelfwise.plans.catalog import QUERIES

    rows = [(k, f"left{k} right{k}") for k in range(8)] + [(8, "alone"), (9, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r["doc_id"], r["pos"]): r["value"] for r in QUERIES["word2vec"](spark, str(tmp_path)).collect()}
    assert len(found) == 30 and any(found[k, p] for k in range(8) for p in range(3)) and not any(found[8, p] for p in range(3))


def test_term_vectors_meet_as_numbers(spark, monkeypatch):
    """Chunks of few tokens and texts over several of them give the counts of whole texts; unknown terms keep their places."""
    from shelfwise.operators import text as tx

    monkeypatch.setattr(tx, "CHUNK", 9)
    draw = random.Random(4)
    rows = [[draw.choice("abcdef") for _ in range(draw.randint(0, 25))] for _ in range(20)]
    numbers = {t: 7 * k for k, t in enumerate("abcde")}
    df = spark.createDataFrame([(r,) for r in rows], "tokens array<string>")
    got = tx.number_tokens(df, spark.createDataFrame(list(numbers.items()), "term string, ix long"))
    assert sorted(map(str, (r["ids"] for r in got.collect()))) == sorted(str([numbers.get(t) for t in r]) for r in rows if r)
    want = Counter((numbers[r[i]], numbers[r[j]]) for r in rows for i in range(len(r)) for j in range(len(r)) if 0 < abs(i - j) <= 2 and "f" not in (r[i], r[j]))
    assert {(r["a"], r["b"]): r["n"] for r in tx.neighbouring_terms(got, 2, "ids").collect()} == dict(want)


def test_topic_fit_is_that_of_spark(spark):
    """Both numbers from one pass over the documents, none of Spark's, which take the exponential of the whole model for each."""
    rng = np.random.default_rng(7)
    rows = [Vectors.sparse(30, sorted((int(i), float(rng.integers(1, 5)) / 2) for i in rng.choice(30, 6, replace=False))) for _ in range(300)]
    rows += [Vectors.dense(rng.random(30).tolist()), Vectors.sparse(30, [], []), Vectors.sparse(30, [3], [0.0])]
    df = spark.createDataFrame([(v,) for v in rows], ["features"])
    model = models.estimator("lda", k=3, maxIter=5, seed=3, optimizer="online").fit(df)
    want = model.logLikelihood(df), model.logPerplexity(df)

    class OnePass:
        def __getattr__(self, name):
            assert name not in ("logLikelihood", "logPerplexity")
            return getattr(model, name)

    fit = models.topic_fit(OnePass(), df)
    assert (fit["log_likelihood"], fit["log_perplexity"]) == pytest.approx(want, rel=1e-4)


def test_best_items_of_single_precision(spark, monkeypatch):
    """Factors of single precision are not widened before they are sent or held, and give the scores of their exact products."""
    rng, kinds = np.random.default_rng(6), set()
    monkeypatch.setattr(blocks, "ITEMS", 64)
    monkeypatch.setattr(blocks, "durable", lambda df, f=blocks.durable: kinds.add(df.schema["v"].dataType.simpleString() if "v" in df.columns else None) or f(df))
    users, items = (rng.normal(size=(n, 8)).astype(np.float32) for n in (40, 200))
    frames = [spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(m)], f"{c} long, v array<float>") for m, c in ((users, "u"), (items, "i"))]
    found, _ = blocks.best_items(*frames, 4)
    scores = np.round(users.astype(float) @ items.astype(float).T, 6)
    want = [(u, k, i, scores[u, i]) for u in range(40) for k, i in enumerate(np.lexsort((np.arange(200), -scores[u]))[:4].tolist(), 1)]
    assert sorted(map(tuple, found.collect())) == want and kinds == {"array<float>", None}
    held = blocks._Slice(np.arange(200), items, blocks.centres(blocks._directions(items.astype(float)), 4), 4)
    assert held.rows.dtype == np.float32 and held.single is held.rows


def test_als_blocks_grow_with_the_ratings(spark, monkeypatch):
    weighted = spark.createDataFrame([(u, i, 1.0 + (u * i) % 3) for u in range(12) for i in range(9) if (u + i) % 2], "u long, i long, w double")
    made, whole = [], models.ALS
    monkeypatch.setattr(models, "ALS", lambda **options: made.append(options) or whole(**options))
    models.Factors(weighted, rounds=1)
    monkeypatch.setattr(models, "RATINGS", 3)
    assert models.Factors(weighted, rounds=1).for_users(2).count() == 24
    assert [(x["numUserBlocks"], x["numItemBlocks"]) for x in made] == [(10, 10), (18, 18)]


def test_als_ids_beyond_int(spark, pairs):
    rng = random.Random(2)
    weights = {p: float(rng.randint(1, 5)) for p in pairs}
    small = spark.createDataFrame([(u, i, w) for (u, i), w in weights.items()], "u long, i long, w double").coalesce(1)
    shift = 10**12
    big = small.select((F.col("u") + shift).alias("u"), (F.col("i") + shift).alias("i"), "w")
    found = models.Factors(big, rank=3, rounds=2)
    rows = found.for_users(4).collect()
    assert {r["user_id"] for r in rows} == {u + shift for u, _ in pairs}
    assert all(r["item_id"] >= shift and 1 <= r["rank"] <= 4 and not math.isnan(r["score"]) for r in rows)
    some = found.for_items(3, big.select("i").where(F.col("i") < shift + 2).distinct()).collect()
    assert {r["item_id"] for r in some} <= {shift, shift + 1} and len(some) <= 6
    assert found.predict(big).count() == len(pairs)


def test_repartitioning_changes_nothing(table):
    one, many = table.coalesce(1), table.repartition(13, "i")
    for job in (lambda t: recommend.similar_users(t, 8), lambda t: ids.index_pairs(t), lambda t: sim.mean_item_cosine(t, 8).withColumn("score", F.round("score", 9))):
        assert sorted(job(one).collect()) == sorted(job(many).collect())


def test_bayes_matches_spark(spark):
    docs = [(0, "a a b", 0), (1, "b c", 1), (2, "c c d a", 1), (3, "a d", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, label int").withColumn("tokens", F.split("text", " "))
    from shelfwise.operators import text as tx

    vectorizer = tx.fit_counts(df)
    model = models.estimator("naive_bayes", featuresCol="counts", smoothing=1.0).fit(vectorizer.transform(df))
    theta = model.theta.toArray()
    want = {(c, w): theta[c, j] for c in (0, 1) for j, w in enumerate(vectorizer.vocabulary)}
    counts = tx.document_terms(df, "doc_id")
    got = {(r["label"], r["term"]): r["logprob"] for r in models.bayes_log_probabilities(counts, df.select("doc_id", "label"), "doc_id", [0, 1]).collect()}
    assert got == pytest.approx(want)


def test_dot(spark):
    row = spark.createDataFrame([([1.0, 2.0], [3.0, 4.0])], "a array<double>, b array<double>").select(dot(F.col("a"), F.col("b")).alias("d"))
    assert row.first()["d"] == 11.0


def test_two_level(spark):
    df = spark.createDataFrame([(1, 1, 2.0), (1, 1, 4.0), (2, 1, 3.5), (2, 2, 1.0)], "u long, i long, q double")
    assert {tuple(r) for r in rel.best_average(df).collect()} == {(1, 3.5), (2, 1.0)}


def test_pairs_helper_is_skewed(pairs):
    assert max(Counter(u for u, _ in pairs).values()) == 60
    assert len(list(itertools.chain(pairs))) == len(set(pairs))


def test_weighted_vectors_have_no_vocabulary_bound(spark):
    """As the Spark ML stages give them, a row for each row, repeated ids and texts without terms too."""
    from shelfwise.operators import text as tx

    texts = [["the", "a", "b", "b"], ["the", "b", "c"], ["the", "a", "d"], [], ["the"], ["the", "c", "a"]]
    df = spark.createDataFrame(list(zip([1, 2, 3, 4, 5, 5], texts)), "id long, tokens array<string>")
    vectors, words = tx.weighted_vectors(df, "id", 1, 2)
    places = {r["ix"]: r["term"] for r in words.collect()}
    kept = tx.remove_words(df, ["the"])
    model = tx.fit_counts(kept, min_documents=2, tokens="kept")
    want = tx.weigh(model.transform(kept), "counts", "w").collect()
    got = [(r["id"], {places[i]: pytest.approx(x) for i, x in zip(r["features"].indices.tolist(), r["features"].values.tolist())}) for r in vectors.collect()]
    assert sorted(places.values()) == ["a", "b", "c"] and all(r["features"].size == 3 for r in vectors.collect())
    for r in want:
        got.remove((r["id"], {model.vocabulary[i]: x for i, x in zip(r["w"].indices.tolist(), r["w"].values.tolist())}))
    assert not got
