"""Exact duplicates by a Golomb-coded fingerprint exchange.

Every partition sends the sorted fingerprints of its rows, Golomb-Rice coded, to the owners of the fingerprint
ranges. An owner answers each sender with a bitmap that marks the fingerprints seen more than once. Only rows with a
marked fingerprint, the suspects, shuffle their bytes, which decide.

A sender names a fingerprint once, however many of its rows carry it, so a text that fills a third of the table costs
an owner one entry per sender. An owner holds about ``OWNER_ROWS`` fingerprints at any table size, since the number of
owners follows the number of rows. Equal texts meet in a partial aggregate before they shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import durable

SPACE = r"[\x20\x09-\x0D]+"
FINGERPRINT_BITS = 48
OWNER_ROWS = 1 << 16
SENDER_ROWS = 1 << 20
#: So many suspect fingerprints (8 bytes each) go to every executor; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000

MESSAGE = "sender long, owner int, n int, k int, unary binary, rest binary, repeated binary"


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def fingerprint(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit((1 << FINGERPRINT_BITS) - 1))


def rice_encode(values: np.ndarray, base: int) -> tuple[int, bytes, bytes]:
    """Ascending distinct ``values`` as ``(k, unary, rest)``: quotients of the gaps in unary, remainders in k bits."""
    gaps = np.diff(values, prepend=np.uint64(base)).astype(np.uint64)
    mean = float(gaps.mean()) if len(gaps) else 1.0
    k = max(0, int(np.log2(max(mean, 1.0) * np.log(2))))
    ends = np.cumsum(gaps >> np.uint64(k)) + np.arange(len(gaps), dtype=np.uint64)
    unary = np.zeros(int(ends[-1]) + 1 if len(ends) else 0, np.uint8)
    unary[ends.astype(np.int64)] = 1
    shifts = np.arange(k, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(rest).tobytes()


def rice_decode(n: int, k: int, unary: bytes, rest: bytes, base: int) -> np.ndarray:
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    quotients = np.diff(ends, prepend=-1).astype(np.uint64) - np.uint64(1)
    bits = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * k].reshape(n, k).astype(np.uint64)
    low = bits @ (np.uint64(1) << np.arange(k, dtype=np.uint64)) if k else np.zeros(n, np.uint64)
    return np.uint64(base) + np.cumsum((quotients << np.uint64(k)) + low)


def first_of(owner: int, owners: int) -> int:
    """The first fingerprint of an owner's range."""
    return -(-(owner << FINGERPRINT_BITS) // owners)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8))[:n].astype(bool)


def _sender(owners: int):
    bounds = np.array([first_of(o, owners) for o in range(owners + 1)], np.uint64)

    def messages(prints: list[np.ndarray], number: int):
        values, counts = np.unique(np.concatenate(prints), return_counts=True)
        cuts = np.searchsorted(values, bounds)
        rows = []
        for owner in np.flatnonzero(np.diff(cuts)):
            part = slice(cuts[owner], cuts[owner + 1])
            k, unary, rest = rice_encode(values[part], int(bounds[owner]))
            n = int(cuts[owner + 1] - cuts[owner])
            rows.append((number, int(owner), n, k, unary, rest, _bits(counts[part] > 1)))
        return rows

    def send(batches):
        task, block, held, part = TaskContext.get().partitionId(), [], 0, 0
        for batch in batches:
            block.append(batch.column("fp").to_numpy(zero_copy_only=False).astype(np.uint64))
            held += batch.num_rows
            if held >= SENDER_ROWS:
                yield _batch(messages(block, task << 24 | part))
                block, held, part = [], 0, part + 1
        if held:
            yield _batch(messages(block, task << 24 | part))

    return send


def _batch(rows):
    schema = pa.schema([("sender", pa.int64()), ("owner", pa.int32()), ("n", pa.int32()), ("k", pa.int32()),
                        ("unary", pa.binary()), ("rest", pa.binary()), ("repeated", pa.binary())])
    return pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)


def _answers(owners: int):
    def answer(table: pa.Table) -> pa.Table:
        """One owner: every sender's fingerprints in, a bitmap for each sender out."""
        rows = table.to_pylist()
        lists = [rice_decode(r["n"], r["k"], r["unary"], r["rest"], first_of(r["owner"], owners)) for r in rows]
        weights = [1 + _flags(r["repeated"], r["n"]).astype(np.int64) for r in rows]
        values, inverse = np.unique(np.concatenate(lists), return_inverse=True)
        seen = np.bincount(inverse, weights=np.concatenate(weights)) > 1
        cuts = np.cumsum([r["n"] for r in rows])[:-1]
        bitmaps = [_bits(part) for part in np.split(seen[inverse], cuts)]
        return pa.table({"sender": table["sender"], "owner": table["owner"], "twice": pa.array(bitmaps, pa.binary())})

    return answer


def _suspects(owners: int):
    def mark(batches):
        for batch in batches:
            found = [
                rice_decode(r["n"], r["k"], r["unary"], r["rest"], first_of(r["owner"], owners))[_flags(r["twice"], r["n"])]
                for r in batch.to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*found, np.zeros(0, np.uint64)]).astype(np.int64))], ["fp"])

    return mark


def suspect_fingerprints(prints: DataFrame) -> DataFrame:
    """``(fp)``: the fingerprints that more than one row of ``prints`` carries."""
    rows = prints.count()
    owners = max(1, -(-rows // OWNER_ROWS), int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sent = durable(prints.select("fp").mapInArrow(_sender(owners), MESSAGE))
    answers = sent.groupBy("owner").applyInArrow(_answers(owners), "sender long, owner int, twice binary")
    marked = sent.drop("repeated").join(answers, ["sender", "owner"])
    return marked.select("owner", "n", "k", "unary", "rest", "twice").mapInArrow(_suspects(owners), "fp long").distinct()


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, a row for each row of ``docs``.

    Texts are equal when identical after ``normalised``; the row with the smallest id stays. Null and empty texts form
    one group. A null id never names a group that has other ids; a group without any id has a null ``keep_id`` and is
    kept. Rows that repeat both id and text share one verdict. Other columns of ``docs`` play no part; an empty table
    gives an empty result.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), normalised(F.col(text)).alias("norm"))
    prints = durable(rows.select("doc_id", fingerprint(F.col("norm")).alias("fp"), F.unhex(F.sha2("norm", 256)).alias("sha")))
    suspects = durable(suspect_fingerprints(prints))
    if suspects.count() <= BROADCAST_ROWS:
        suspects = F.broadcast(suspects)
    bytes_of = rows.withColumn("fp", fingerprint(F.col("norm"))).join(suspects, "fp", "left_semi")
    equal = bytes_of.groupBy("fp", "norm").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("size"))
    groups = equal.where("size > 1").select(F.unhex(F.sha2("norm", 256)).alias("sha"), "first_id", "size")
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("first_id"))
    return prints.join(groups, "sha", "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns; of an id with several texts each is judged.

    Rows without an id share one verdict: where one is a copy, all go.
    """
    gone = exact_duplicates(docs, key, text).where(~F.col("kept")).select(
        F.col("doc_id").alias("_gone"), F.when(F.col("doc_id").isNotNull(), F.unhex("text_sha256")).alias("_gone_sha")
    ).distinct()
    own = docs[key].cast("long")
    sha = F.when(own.isNotNull(), F.unhex(F.sha2(normalised(docs[text]), 256)))
    return docs.join(gone, own.eqNullSafe(gone["_gone"]) & sha.eqNullSafe(gone["_gone_sha"]), "left_anti")
