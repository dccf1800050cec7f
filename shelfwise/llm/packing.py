"""Best-fit packing of token sequences after a Martello-Toth dominance reduction.

Only the lengths decide a packing, and a length is at most the capacity, so the instance is a histogram of at most
``capacity`` counts, whatever the table's size. The driver reduces and packs that histogram: first it fixes document
sets that provably dominate every other set with the same longest document (alone, an exact pair, the best pair when
no two others fit, the best triple when no three do), many bins at a time; then it packs what is left best-fit, longest
first, again by counts. The result is a list of intervals of ranks for each length. Spark numbers the pieces of each
length by a range sort and looks every piece's sequence up in its interval.

The tokenizer works on words split at ASCII white space, which its own splitter never crosses, and remembers them. A
Python worker keeps that memory from task to task.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_right
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.session import durable

CAPACITY = 2048
END_OF_DOCUMENT = 0
WORDS_HELD = 300_000  # of each generation
_SLOT_BITS = 33

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordCodes:
    """Token ids of whole texts, through a bounded memory of words in two generations; used words move to the younger."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = re.compile("|".join(map(re.escape, sorted(str(t) for t in self.tokenizer.get_added_tokens_decoder().values()))).lower().encode() or b"(?!)")
        self.held: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def codes(self, text: bytes) -> bytes:
        """The ids as unsigned 32-bit little-endian numbers. The vocabulary is of lower-case text, so ASCII is lowered
        first, but where a special token's string may stand, which is a token as it is."""
        if b"<" not in text or not self.special.search(text.lower()):
            text = text.lower()
        words, held, old = text.split(), self.held, self.old
        new = [w for w in set(words) if w not in held]
        if len(held) + len(new) > WORDS_HELD:
            self.old, self.held = old, held = held, {}
            new = list(set(words))
        unseen = []
        for word in new:
            code = old.get(word)
            if code is None:
                unseen.append(word)
            else:
                held[word] = code
        for at in range(0, len(unseen), 4096):
            part = unseen[at : at + 4096]
            found = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            for word, code in zip(part, found, strict=True):
                held[word] = array("I", code.ids).tobytes()
        return b"".join(map(held.__getitem__, words))


@lru_cache(maxsize=1)
def word_codes(path: str) -> WordCodes:
    """The tokenizer of this Python worker, with the words it has met."""
    return WordCodes(path)


def _cut(path: str, capacity: int):
    end = array("I", [END_OF_DOCUMENT]).tobytes()

    def cut(batches):
        words = word_codes(path)
        for batch in batches:
            out: list[tuple] = []
            texts = batch.column(1).cast(pa.binary())
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                codes = words.codes(text.as_py() or b"") + end
                total = len(codes) // 4
                for number, start in enumerate(range(0, total, capacity)):
                    piece = codes[4 * start : 4 * (start + capacity)]
                    out.append((doc, number, start, len(piece) // 4, zlib.crc32(piece)))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return cut


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's ids and a closing id 0, cut into pieces of ``capacity`` ids; the last may be shorter.

    A null or empty text has the closing id alone. Repeated rows give their pieces each time.
    """
    slim = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return slim.mapInArrow(_cut(path, capacity), PIECES)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, tuple[int, ...]]], dict[int, int]]:
    """``(fixed, left)``: ``fixed`` holds ``(bins, lengths)`` that some optimal packing contains; ``left`` is the rest.

    With ``j`` the longest open length and ``room`` what it leaves, a set dominates if its members can replace, one
    for one, the parts of any other feasible set that contains ``j``.
    """
    left = {length: n for length, n in counts.items() if n}
    fixed: list[tuple[int, tuple[int, ...]]] = []

    def take(times: int, lengths: tuple[int, ...]) -> None:
        fixed.append((times, lengths))
        for length in lengths:
            left[length] -= times
            if not left[length]:
                del left[length]

    def longest(room: int, used: list[int]) -> int | None:
        at = bisect_right(live, room)
        while at:
            at -= 1
            if left.get(live[at], 0) > used.count(live[at]):
                return live[at]
        return None

    def shortest(k: int, used: list[int]) -> list[int]:
        out: list[int] = []
        for length in live:
            free = left.get(length, 0) - used.count(length)
            out += [length] * min(max(free, 0), k - len(out))
            if len(out) == k:
                break
        return out

    live = sorted(left)
    for j in sorted(left, reverse=True):
        while left.get(j):
            live = [length for length in live if length in left]
            room = capacity - j
            best = longest(room, [j])
            if best is None:
                take(left[j], (j,))
                continue
            pair = left[j] // 2 if best == j else min(left[j], left[best])
            small = shortest(3, [j])
            if best == room or len(small) < 2 or sum(small[:2]) > room:
                take(pair, (j, best))
                continue
            if len(small) == 3 and sum(small) <= room:
                break
            third = longest(room - best, [j, best])
            rivals = [d for d in live if _two_fit(d, room, left, j)]
            if third is None or max(rivals, default=0) > third:
                break
            take(1, (j, best, third))
    return fixed, left


def _two_fit(d: int, room: int, left: dict[int, int], j: int) -> bool:
    """Whether ``d`` and another piece of at least its length fit into ``room`` beside ``j``."""
    if left[d] - (d == j) >= 2 and 2 * d <= room:
        return True
    return left[d] - (d == j) >= 1 and any(c > d and c + d <= room and left[c] - (c == j) >= 1 for c in left)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """``(bins, ((length, copies), ...))``: best fit, longest first, bins with equal content counted together."""
    open_bins: dict[int, list[tuple[int, tuple]]] = defaultdict(list)

    def put(bins: int, content: tuple, room: int) -> None:
        if bins:
            open_bins[room].append((bins, content))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            room = min((r for r, held in open_bins.items() if held and r >= length), default=None)
            bins, content = open_bins[room].pop() if room is not None else (-(-n * length // capacity) + 1, ())
            free = capacity if room is None else room
            each = free // length
            whole = min(bins, n // each)
            put(whole, (*content, (length, each)), free - whole_room(each, length))
            n -= whole * each
            rest = bins - whole
            if rest and 0 < n < each:
                put(1, (*content, (length, n)), free - whole_room(n, length))
                n, rest = 0, rest - 1
            if room is not None:
                put(rest, content, room)
    return [group for held in open_bins.values() for group in held]


def whole_room(copies: int, length: int) -> int:
    return copies * length


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows ``(length, first rank, first sequence, pieces per sequence, offset)``, sorted by length and rank."""
    fixed, left = reduce_by_dominance(counts, capacity)
    groups = best_fit(left, capacity)
    for bins, lengths in fixed:
        groups.append((bins, tuple((length, lengths.count(length)) for length in dict.fromkeys(lengths))))
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for bins, content in groups:
        offset = 0
        for length, copies in content:
            rows.append((length, used[length], sequence, copies, offset))
            used[length] += bins * copies
            offset += length * copies
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _assign(layout: np.ndarray, bases: np.ndarray):
    """``bases``: rows ``(partition, length, first slot, first rank)``, sorted by partition and length."""
    interval = layout[:, 0] << 44 | layout[:, 1]
    run = bases[:, 0] << 24 | bases[:, 1]

    def assign(batches):
        for batch in batches:
            slot, length = (batch.column(c).to_numpy() for c in ("slot", "length"))
            at = np.searchsorted(run, (slot >> _SLOT_BITS) << 24 | length)
            rank = bases[at, 3] + slot - bases[at, 2]
            _, first, sequence, each, offset = layout[np.searchsorted(interval, length << 44 | rank, "right") - 1].T
            place = rank - first
            names = [f for f in batch.schema.names if f != "slot"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence + place // each), pa.array(offset + place % each * length)],
                [*names, "sequence_id", "offset"],
            )

    return assign


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (as from ``pieces``) with ``sequence_id`` and ``offset``, in as few sequences as the method finds.

    The table is written once, sorted by length over range partitions that also cut inside a length, so a length that
    a third of the pieces share is spread. Runs of one length within a partition number at most the partitions plus
    the capacity; they and the histogram are all that the driver sees.
    """
    ordered = durable(
        durable(found).repartitionByRange("length", "doc_id", "piece").sortWithinPartitions("length", "doc_id", "piece")
        .withColumn("slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("slot", _SLOT_BITS).alias("part")
    runs = ordered.groupBy(part, "length").agg(F.min("slot").alias("slot"), F.count(F.lit(1)).alias("n")).collect()
    counts: dict[int, int] = defaultdict(int)
    bases = []
    for r in sorted(runs):
        bases.append((r["part"], r["length"], r["slot"], counts[r["length"]]))
        counts[r["length"]] += r["n"]
    assign = _assign(plan(counts, capacity), np.array(bases, np.int64).reshape(-1, 4))
    return ordered.mapInArrow(assign, f"{PIECES}, sequence_id long, offset long")
