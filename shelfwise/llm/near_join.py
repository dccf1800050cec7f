"""N-gram Jaccard join: MinHash candidates, Bayesian pruning, exact verification.

1. Texts equal in their words are one node, so copies are never compared. Its number is their smallest id, or a hash where
   that id has several texts.
2. A node's ``BANDS`` keys of ``ROWS`` MinHash values each put it into buckets; at the threshold a pair shares none of
   them once in about a hundred thousand times. Only buckets of two or more nodes go on, and only their nodes' other
   MinHash values, ``CHECKS`` of them, travel.
3. Within a bucket nodes are compared by those values, ``STEP`` at a time. With ``m`` of ``n`` equal and a flat prior the
   posterior probability of reaching the threshold is a binomial tail; below ``TOLERANCE`` the pair is dropped. What
   survives joins nodes into groups (a spanning forest leaves the task, not the pairs; a node already in the group of
   the one it is compared with needs no comparison).
4. The texts of groups of two or more meet once, and all pairs within a group are verified exactly by their shingles.
   Each node gets the number of its links; a spanning forest of the true links gives the classes.

A bucket or group larger than ``BLOCK`` nodes (or, where texts meet, than about ``BLOCK_SHINGLES`` shingles) is cut into
blocks, and every pair of blocks is a unit of its own, so no task grows with a bucket or a group of near copies.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.relational import few
from shelfwise.session import durable, forget, release

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 28, 5
CHECKS, STEP = 64, 8
TOLERANCE = 1e-6
BLOCK, BLOCK_SHINGLES = 1024, 1 << 19
BATCH_ROWS, BATCH_TEXTS = 20_000, 2_000
WORDS_HELD = 400_000
BROADCAST_ROWS = 500_000


def _constants(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(seed).integers(0, 1 << 32, (2, n), dtype=np.uint64).astype(np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


class Shingles:
    """64-bit hashes of the distinct runs of ``WIDTH`` words; a shorter text is one shingle, an empty one has none."""

    def __init__(self) -> None:
        self.held: dict[str, int] = {}

    def of(self, text: str) -> np.ndarray:
        words, held = text.split(" ") if text else [], self.held
        if not words:
            return np.zeros(0, np.uint64)
        new = [w for w in set(words) if w not in held]
        if len(held) + len(new) > WORDS_HELD:
            held.clear()
            new = set(words)
        for word in new:
            held[word] = xxhash.xxh3_64_intdigest(word)
        codes = np.fromiter(map(held.__getitem__, words), np.uint64, len(words))
        width = min(WIDTH, len(codes))
        mixed = np.full(len(codes) - width + 1, len(codes) if width < WIDTH else WIDTH, np.uint64)
        for k in range(width):
            mixed = (mixed ^ codes[k : len(codes) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def min_hashes(shingles: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 2048):
        best = np.minimum(best, (low[at : at + 2048, None] * factors + terms).min(axis=0))
    return best


def plain_words(text: Column) -> Column:
    """Lower-case words joined by one space; null counts as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", " "))


def _sign(batches):
    shingles = Shingles()
    band_constants, check_constants = _constants(BANDS * ROWS, 1), _constants(CHECKS, 2)
    powers = np.array([0x9E3779B97F4A7C15 ** k % (1 << 64) for k in range(1, ROWS + 1)], np.uint64)
    for batch in batches:
        nodes, names, sizes, keys, checks = [], [], [], [], []
        for node, name, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found = shingles.of(text)
            if not len(found):
                continue
            values = min_hashes(found, *band_constants).reshape(BANDS, ROWS).astype(np.uint64)
            mixed = (values * powers).sum(axis=1) + np.arange(BANDS, dtype=np.uint64)
            nodes.append(node)
            names.append(name)
            sizes.append(len(found))
            keys.append(((mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64))
            checks.append((min_hashes(found, *check_constants) >> np.uint32(24)).astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes, pa.int64()), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(keys, pa.list_(pa.int64())), pa.array(checks, pa.binary())], ["doc_id", "name", "n", "bands", "checks"]
        )


def posterior(equal: int, seen: int, threshold: float = THRESHOLD) -> float:
    """Probability that a pair reaches the threshold, by a flat prior, when ``equal`` of ``seen`` values agree.

    The values are cut to eight bits, so unequal ones agree once in 256 times.
    """
    p = threshold + (1 - threshold) / 256
    return sum(comb(seen + 1, k) * p**k * (1 - p) ** (seen + 1 - k) for k in range(equal + 1))


def least_equal(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For each step, the fewest agreeing values with which a pair goes on."""
    return [next(m for m in range(n + 1) if posterior(m, n, threshold) >= tolerance) for n in range(STEP, CHECKS + 1, STEP)]


class _Forest:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.root[max(x, y)] = min(x, y)
        return x != y


def _likely(node: np.ndarray, checks: np.ndarray, side: np.ndarray, two: bool, least: list[int]):
    """Forest edges of one block, or of ``two`` blocks (``side`` 0 and 1), where only pairs across them count."""
    roots, edges = np.arange(len(node)), []
    for x in np.flatnonzero(side == 0) if two else range(len(node) - 1):
        others = np.flatnonzero((roots != roots[x]) & (side == 1)) if two else x + 1 + np.flatnonzero(roots[x + 1 :] != roots[x])
        equal = np.zeros(len(others), np.int64)
        for step, fewest in enumerate(least):
            part = slice(step * STEP, (step + 1) * STEP)
            equal += (checks[others, part] == checks[x, part]).sum(axis=1)
            going = equal >= fewest
            others, equal = others[going], equal[going]
            if not len(others):
                break
        for y in others:
            if roots[x] != roots[y]:
                edges.append((node[x], node[y]))
                roots[roots == roots[y]] = roots[x]
    return edges


def _rows_by_group(table: pa.Table, names: list[str]):
    """Slices of a table sorted by ``names``, one for each group."""
    table = table.sort_by([(n, "ascending") for n in names]).combine_chunks()
    columns = [table[n].to_numpy() for n in names]
    changed = np.zeros(table.num_rows, bool)
    for column in columns:
        changed[1:] |= column[1:] != column[:-1]
    cuts = [0, *np.flatnonzero(changed).tolist(), table.num_rows]
    for start, end in zip(cuts, cuts[1:], strict=False):
        if end > start:
            yield table.slice(start, end - start)


def _of_two(rows: pa.Table) -> bool:
    """Whether a group is a pair of two blocks, one of which may be empty, and not one block with itself."""
    return rows["i"][0].as_py() != rows["j"][0].as_py()


def _edge_table(edges) -> pa.Table:
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _in_buckets(least: list[int]):
    def compare(table: pa.Table) -> pa.Table:
        edges = []
        for rows in _rows_by_group(table, ["band", "i", "j"]):
            if rows.num_rows > 1:
                checks = np.frombuffer(b"".join(rows["checks"].to_pylist()), np.uint8).reshape(-1, CHECKS)
                edges += _likely(rows["node"].to_numpy(), checks, rows["side"].to_numpy(), _of_two(rows), least)
        return _edge_table(edges)

    return compare


def in_block_pairs(rows: DataFrame, group: str, size: str) -> DataFrame:
    """Each row once for every pair of blocks it belongs to: ``i <= j`` and ``side``, 0 for block ``i``, 1 for ``j``."""
    blocks = F.ceil(F.col(size) / BLOCK).cast("int")
    block = F.pmod(F.xxhash64(F.col("node"), F.lit(7)), blocks).cast("int")
    others = F.sequence(F.lit(0), blocks - 1)
    pair = F.struct(F.least(block, F.col("_other")).alias("i"), F.greatest(block, F.col("_other")).alias("j"),
                    (block > F.col("_other")).cast("int").alias("side"))
    return rows.withColumn("_other", F.explode(others)).select("*", pair.alias("_pair")).select("*", "_pair.*").drop("_other", "_pair", size)


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` by alternating large and small stars; the component is its smallest node.

    Every round is written to the shared folder. A star's centre is reached through a grouped minimum, which combines
    before the shuffle, so a node with very many edges is no burden.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    current = durable(pairs)
    before = None
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = durable(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = durable(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        stamp = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        release(current, large)
        current = after
        if stamp == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = stamp


def _batches(table: DataFrame, rows: int) -> int:
    """How many batches of about ``rows`` rows a written table makes, at least one for each shuffle partition."""
    return max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), table.count() // rows + 1)


def likely_edges(signed: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """``(a, b)``: forest edges of the nodes that share a bucket and survive the pruning."""
    keyed = signed.select("node", F.explode("bands").alias("band"))
    shared = keyed.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = durable(keyed.join(shared, "band"))
    checks = signed.select("node", "checks").join(members.select("node").distinct(), "node")
    rows = in_block_pairs(members.join(checks, "node"), "band", "size")
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("band", "i", "j"), F.lit(_batches(members, BATCH_ROWS))))
    return rows.groupBy("batch").applyInArrow(_in_buckets(least_equal(threshold, tolerance)), "a long, b long").distinct()


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each left set shares with each right set, by blocks of a 0/1 matrix over shared shingles."""
    every = [*left, *right]
    values, inverse, counts = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(every)), [len(s) for s in every])
    useful = counts > 1
    column = (np.cumsum(useful) - 1)[inverse]
    kept = useful[inverse]
    owner, column = owner[kept], column[kept]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)), np.float32)
    width = 2048
    for start in range(0, int(useful.sum()), width):
        part = slice(*np.searchsorted(column, (start, start + width)))
        matrix = np.zeros((len(every), width), np.float32)
        matrix[owner[part], column[part] - start] = 1
        total += matrix[: len(left)] @ matrix[len(left) :].T
    return total


def _verify(threshold: float):
    def verify(table: pa.Table) -> pa.Table:
        shingles, out = Shingles(), []
        for rows in _rows_by_group(table, ["component", "i", "j"]):
            if rows.num_rows < 2:
                continue
            node, side = rows["node"].to_numpy(), rows["side"].to_numpy()
            two = _of_two(rows)
            if two and side.max() == side.min():
                continue
            sets = [shingles.of(t) for t in rows["words"].to_pylist()]
            left = np.flatnonzero(side == 0) if two else np.arange(len(node))
            right = np.flatnonzero(side == 1) if two else left
            common = _common([sets[k] for k in left], [sets[k] for k in right])
            size = np.array([len(s) for s in sets], np.float32)
            linked = common >= threshold * (size[left][:, None] + size[right][None, :] - common) - 1e-4
            if not two:
                np.fill_diagonal(linked, False)
            linked &= node[left][:, None] != node[right][None, :]
            degrees = [(left, linked.sum(axis=1))] + ([(right, linked.sum(axis=0))] if two else [])
            for places, degree in degrees:
                out += [(int(node[k]), int(d), None, None) for k, d in zip(places, degree, strict=True) if d]
            forest = _Forest(len(node))
            for x, row in zip(left, linked, strict=True):
                for y in right[row]:
                    if forest.join(int(x), int(y)):
                        out.append((None, None, int(node[x]), int(node[y])))
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("node", "links", "a", "b"), columns, strict=True)})

    return verify


def near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, class_id, n_links, n_copies)``, a row for each row of ``docs``.

    ``class_id`` is the smallest id of the documents linked directly or through others, ``n_links`` the number of other
    texts with a Jaccard similarity of at least ``threshold`` over five-word shingles, ``n_copies`` the rows with the same
    words. Null, empty and blank texts are one class without links. A text of fewer than five words is one shingle. A row
    without an id shares the class of rows with its words; where none has an id its class is null. Of rows with one id but
    different words each is judged by its own. Other columns play no part; an empty table gives an empty result.
    """
    return _judged(docs, threshold, tolerance, key, text).drop("name", "kept")


def _judged(docs: DataFrame, threshold: float, tolerance: float, key: str, text: str) -> DataFrame:
    """The rows of ``near_duplicates`` with the digest of their words and whether they stand for their class."""
    words = docs.select(F.col(key).cast("long").alias("doc_id"), plain_words(F.col(text)).alias("words"))
    named = durable(words.select("doc_id", F.unhex(F.md5("words")).alias("name")))
    names = durable(named.groupBy("name").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n_copies")))
    several = few(names.where("first is not null").groupBy("first").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"))
    other = -F.shiftrightunsigned(F.xxhash64("name"), 1) - 1
    names = names.join(several, "first", "left").select("name", "first", "n_copies", F.when(F.col("texts").isNull(), F.col("first")).otherwise(other).alias("node"))
    keyed = words.withColumn("name", F.unhex(F.md5("words")))
    firsts = names.where("first is not null").select(F.col("first").alias("doc_id"), "name", "node")
    signed = durable(
        keyed.where("doc_id is not null").select("doc_id", "name", "words")
        .mapInArrow(_sign, "doc_id long, name binary, n long, bands array<long>, checks binary")
        .join(firsts, ["doc_id", "name"]).dropDuplicates(["doc_id", "name"]).drop("doc_id", "name")
    )
    forget(docs.sparkSession)
    return _classes(named, names, keyed, signed, threshold, tolerance)


def _classes(named, names, keyed, signed, threshold, tolerance) -> DataFrame:
    groups = components(likely_edges(signed, threshold, tolerance))
    weight = F.greatest(F.count(F.lit(1)), F.ceil(F.sum("n") * BLOCK / BLOCK_SHINGLES))
    sizes = groups.join(signed.select("node", "n"), "node").groupBy("component").agg(weight.alias("size"))
    members = durable(groups.join(sizes, "component"))
    forget(signed.sparkSession)
    chosen = members.join(names.where("first is not null").select("node", "first", "name"), "node")
    if members.count() <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    texts = keyed.join(chosen, (keyed["doc_id"] == chosen["first"]) & (keyed["name"] == chosen["name"])).select("node", "component", "size", "words")
    rows = in_block_pairs(texts.dropDuplicates(["node", "words"]), "component", "size")
    rows = rows.withColumn("batch", F.pmod(F.xxhash64("component", "i", "j"), F.lit(_batches(members, BATCH_TEXTS))))
    found = durable(rows.groupBy("batch").applyInArrow(_verify(threshold), "node long, links long, a long, b long"))
    forget(signed.sparkSession)
    links = found.where("node is not null").groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = durable(components(found.where("a is not null").select("a", "b")).join(names.select("node", "first", "name"), "node"))
    heads = classes.groupBy("component").agg(F.min(F.struct("first", "name")).alias("head"))
    of_node = classes.join(heads, "component").select("node", "head")
    of_name = (
        names.join(of_node, "node", "left").join(links, "node", "left")
        .select("name", F.coalesce("head.first", "first").alias("class_id"), F.coalesce("head.name", "name").alias("head"),
                F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "n_copies")
    )
    kept = F.col("doc_id").isNull() | ((F.col("doc_id") == F.col("class_id")) & (F.col("name") == F.col("head")))
    return named.join(of_name, "name").select("doc_id", "class_id", "n_links", "n_copies", "name", kept.alias("kept"))


def drop_near_duplicates(
    docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stand for their class, with all their columns.

    Of a class the smallest id stays; where that id has several texts in it, the one whose digest comes first. A text that is
    like no other stays, whatever other texts its id has. A row without an id stays, and so do rows that repeat both id and
    words. Null, empty and blank texts are one class. An empty table stays empty.
    """
    gone = _judged(docs, threshold, tolerance, key, text).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"), F.col("name").alias("_gone_name")).distinct()
    name = F.unhex(F.md5(plain_words(docs[text])))
    return docs.join(gone, (docs[key].cast("long") == gone["_gone"]) & (name == gone["_gone_name"]), "left_anti")
