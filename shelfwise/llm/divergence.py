"""Source divergence audit: how far the word shares of each source lie from those of the others and of its language.

1. Tasks count terms and their documents by language and source; one grouped sum makes the counts of the corpus.
2. The vocabulary of a language is numbered in an order that puts terms with the same sources and counts side by side.
   It is cut into chunks of ``CHUNK`` terms, and the counts of each source in a chunk are run-length encoded. Most terms
   are rare and miss most sources, so a column is a few long runs of zeros and ones between short ones.
3. For two sources the run boundaries are intersected and the divergence of each common run is multiplied by its length.
   A unit of work is a chunk and a pair of blocks of about ``BLOCK`` sources, so neither a large vocabulary nor many
   sources meet in one task, and a source that holds most rows is one column like any other.

All shares are whole numbers computed without rounding errors.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.ids import dense_index
from shelfwise.operators.relational import top_k_per_group
from shelfwise.session import durable

SCALE = 1_000_000_000
LEAST_DOCUMENTS = 3
TOP_TERMS = 200
CHUNK = 1 << 16
BLOCK = 64
HELD = 800_000  # counters of one task before they are passed on
TERMS_AT_ONCE = 1 << 20

_TERM = re.compile(rb"[a-z\x80-\xff]+")  # in lower-cased UTF-8: ASCII letters and everything beyond ASCII
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _terms(text: bytes):
    """The terms of a text; those of a long one in lists of ``TERMS_AT_ONCE``."""
    if len(text) <= TERMS_AT_ONCE:
        yield _TERM.findall(text)
        return
    found = _TERM.finditer(text)
    while part := [m[0] for m in islice(found, TERMS_AT_ONCE)]:
        yield part


def _count(batches):
    groups, held = {}, 0

    def passed_on():
        columns = [[], [], [], [], []]
        for (lang, source), (total, spread) in groups.items():
            numbers = np.fromiter(total.values(), np.int64, len(total)), np.fromiter(map(spread.__getitem__, total), np.int64, len(total))
            for column, part in zip(columns, (pa.repeat(lang, len(total)), pa.repeat(source, len(total)), pa.array(total, pa.binary()), *map(pa.array, numbers)), strict=True):
                column.append(part)
        groups.clear()
        kinds = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array([], k), *c]) for c, k in zip(columns, kinds, strict=True)], ["lang", "source", "term", "n", "d"])

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            total, spread = groups.setdefault((lang, source), (Counter(), Counter()))
            before = len(total)
            seen = set()
            for part in _terms(text.translate(_LOWER)):
                total.update(part)
                seen.update(part)
            spread.update(seen)
            held += len(total) - before
            if held >= HELD:
                yield passed_on()
                held = 0
    yield passed_on()


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, source, term, n, d)``: occurrences and documents of each term; null columns count as ''."""
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    counted = rows.mapInArrow(_count, "lang string, source string, term binary, n long, d long")
    return counted.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def ordered_vocabulary(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``(lang, term, place, in_lang)``: the kept terms of each language, numbered so that equal columns lie together."""
    kept = counts.groupBy("lang", "term").agg(
        F.sum("d").alias("d"), F.sum("n").alias("in_lang"), F.count(F.lit(1)).alias("sources"),
        F.min(F.xxhash64("source")).alias("least"), F.max(F.xxhash64("source")).alias("most"),
    ).where(F.col("d") >= least)
    kept = durable(kept.select(F.struct("lang", "sources", "least", "most", "in_lang", "term").alias("key")))
    numbered = durable(dense_index(kept, "key", "place").select("key.lang", "key.term", "key.in_lang", "place"))
    first = numbered.groupBy("lang").agg(F.min("place").alias("first"))
    return numbered.join(first, "lang").select("lang", "term", (F.col("place") - F.col("first")).alias("place"), "in_lang")


def encode_runs(places: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run starts and values of a column given by its places with a count, in ascending order; the rest is zero."""
    edges = np.stack([places, places + 1], axis=1).ravel()
    values = np.stack([counts, np.zeros_like(counts)], axis=1).ravel()
    if not len(places) or places[0] > 0:
        edges, values = np.concatenate([[0], edges]), np.concatenate([[0], values])
    last = np.append(edges[1:] != edges[:-1], True)  # where the next count follows at once, the zero between has no length
    edges, values = edges[last], values[last]
    new = np.append(True, values[1:] != values[:-1])
    return edges[new].astype(np.int64), values[new].astype(np.int64)


def _encode(batches):
    for batch in batches:
        rows = [encode_runs(*(np.array([e[k] for e in held], np.int64) for k in ("at", "n"))) for held in batch.column("held").to_pylist()]
        starts, values = (pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in (0, 1))
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("lang", "source", "chunk")), starts, values], ["lang", "source", "chunk", "starts", "counts"])


def share(count: int, total: int, vocabulary: int) -> int:
    """The smoothed share of a term in billionths, at least 1."""
    return 1 + SCALE * (count + 1) // (total + vocabulary)


def run_divergence(first, second, width: int) -> tuple[int, int]:
    """Sums over a chunk of (p-q)^2/q and (p-q)^2/p, floored for each term; columns are run starts with shares."""
    starts = np.union1d(first[0], second[0])
    starts = starts[starts < width]
    lengths = np.diff(starts, append=width)
    p, q = (side[1][np.searchsorted(side[0], starts, side="right") - 1] for side in (first, second))
    square = (p - q) * (p - q)
    return int((square // q * lengths).sum()), int((square // p * lengths).sum())


def _pairs(table: pa.Table) -> pa.Table:
    columns, sides, out = {}, {}, []
    rows = table.to_pylist()
    for r in rows:
        counts = np.array(r["counts"] or [0], np.int64)
        values, inverse = np.unique(counts, return_inverse=True)
        if r["width"]:
            shares = np.array([share(int(c), r["total"], r["vocabulary"]) for c in values], np.int64)[inverse]
            columns[r["source"]] = np.array(r["starts"] or [0], np.int64), shares
        sides[r["source"]] = r["side"]
    two, names = rows[0]["i"] != rows[0]["j"], sorted(sides)
    for k, a in enumerate(names):
        for b in names[k + 1 :]:
            if not two or sides[a] != sides[b]:
                forth, back = run_divergence(columns[a], columns[b], rows[0]["width"]) if rows[0]["width"] else (0, 0)
                out += [(rows[0]["lang"], a, b, forth), (rows[0]["lang"], b, a, back)]
    found = list(zip(*out, strict=True)) or [[]] * 4
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("lang", "source", "item", "value"), found, (pa.string(),) * 3 + (pa.int64(),), strict=True)})


def _pair_sums(groups: DataFrame, entries: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` of all pairs of sources of a language."""
    at = F.struct((F.col("place") % CHUNK).alias("at"), "n")
    runs = (
        entries.groupBy("lang", "source", (F.col("place") / CHUNK).cast("int").alias("chunk")).agg(F.sort_array(F.collect_list(at)).alias("held"))
        .mapInArrow(_encode, "lang string, source string, chunk int, starts array<long>, counts array<long>")
    )
    last = F.greatest(F.ceil(F.col("vocabulary") / CHUNK).cast("int") - 1, F.lit(0))
    columns = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), last))).join(runs, ["lang", "source", "chunk"], "left")
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    units = columns.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", "source", "chunk", "total", "vocabulary", "starts", "counts",
        F.least(F.lit(CHUNK), F.col("vocabulary") - F.col("chunk") * CHUNK).cast("long").alias("width"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    parts = units.groupBy("lang", "chunk", "i", "j").applyInArrow(_pairs, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _share(count: str, total: str) -> Column:
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10, 0)) * (CAST({count} AS DECIMAL(18, 0)) + 1) div ({total} + vocabulary)")


def divergence(
    docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, lang: str = "lang", source: str = "source", text: str = "text"
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair``: for each source of a language every other one, by divergence. Part ``term``: the ``top`` terms that a
    source uses more than its language does. Equal values go by item. Terms are runs of ASCII letters, lower-cased, and of
    characters beyond ASCII; a language keeps those in at least ``least`` of its rows, repeated rows each counting. Null
    lang, source and text count as ''. A source without terms has the smoothed share of an absent term everywhere; a
    language without kept terms has pairs of value 0 and no terms; one with a single source has no pairs. Long texts are
    counted in parts. Other columns play no part; an empty table gives an empty result.
    """
    counts = durable(term_counts(docs, lang, source, text))
    vocabulary = ordered_vocabulary(counts, least)
    entries = durable(counts.join(vocabulary.hint("shuffle_hash"), ["lang", "term"]).select("lang", "source", "term", "n", "place", "in_lang"))
    names = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source")))).distinct()
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = durable(names.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0).cast("long")).alias("total")))
    sizes = entries.groupBy("lang").agg((F.max("place") + 1).alias("vocabulary"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    langs = langs.join(sizes, "lang", "left").withColumn("vocabulary", F.coalesce("vocabulary", F.lit(0).cast("long")))
    groups = groups.join(langs, "lang")
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    pairs = _pair_sums(groups, entries).select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(place).alias("rank"))
    shares = entries.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), _share("n", "total").alias("p"), _share("in_lang", "lang_total").alias("q")
    )
    above = shares.where("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    above = above.withColumn("group", F.struct("lang", "source"))
    terms = top_k_per_group(above, "group", top, F.desc("value"), F.asc("item")).select("lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return pairs.unionByName(terms)
