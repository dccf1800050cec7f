"""Phrases whose words occur together more often than their parts do, by Rabin-Karp: fingerprints, then the texts themselves.

1. A task packs its texts, language by language, into blocks of about ``BLOCK_WORDS`` words, which are written down once.
2. The words of a block are hashed by prefix polynomials over their bytes, and every run of up to ``longest`` words by
   prefix polynomials over the word hashes. Runs with one 56-bit fingerprint and one 24-bit check from a second polynomial
   are one entry. The sorted entries go, packed, as ``SENT_BITS`` bits and a count to the owners of the fingerprint ranges.
   These add up the counts and answer each block by one bit for each of its entries: whether it can be frequent at all.
3. A block meets its answers. The words of its entries are compared; what is not equal is split. The text of every entry that
   can be frequent goes with its count to an owner, which adds up the counts of equal texts.
4. Frequent phrases are joined with their parts as text and scored by exact decimals.

Runs with one fingerprint are counted together in step 2, so a frequent run always passes, and step 3 counts by text alone:
collisions cost some bytes and never change a result. A frequent run costs an owner one entry for each block, however
often it occurs, and an owner holds about ``OWNER_BYTES`` bytes' worth of text runs at any table size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.columns import gaps, packed, unpacked
from shelfwise.operators.relational import top_k_per_group
from shelfwise.session import durable, forget, release

LEAST, LONGEST, TOP = 10, 3, 2000
INSIDE = (100, 50)  # a phrase goes when 100 times a longer one's count is at least 50 times its own
BLOCK_WORDS, BLOCK_BYTES = 700_000, 1 << 24
PRINT_BITS, CHECK_BITS, SENT_BITS = 56, 24, 40
OWNER_BYTES = 8_000_000
OWNERS_BESIDE = 4  # so many fingerprint owners stand against one owner of texts
STRIP = 1 << 19

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)  # 0 within a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_MARKED = bytes(32 if k else 120 for k in _KIND)

PACKED = "langs array<string>, ends array<long>, words array<long>, text binary"
MESSAGE = "owner int, block long, size int, n long, prints binary, counts binary"
REPLY = "block long, size int, owner int, n long, bits binary"
SPELLED = "owner int, n long, langs array<string>, which binary, sizes binary, counts binary, lengths binary, text binary"
FOUND = "lang string, phrase binary, size int, total long"


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


class Polynomial:
    """Hashes of slices of a sequence from its prefix sums, modulo 2**64; bytes stand for random numbers."""

    def __init__(self, seed: int):
        drawn = np.random.default_rng(seed).integers(0, 1 << 64, 259, dtype=np.uint64)
        self.of_byte, self.base, self.salts = drawn[:256], int(drawn[256]) | 5, drawn[257:]
        self.power = self.inverse = np.ones(1, np.uint64)

    def _tables(self, n: int) -> None:
        if len(self.power) < n:
            def table(base: int) -> np.ndarray:
                factors = np.full(n, base, np.uint64)
                factors[0] = 1
                return np.cumprod(factors)

            self.power, self.inverse = table(self.base), table(pow(self.base, -1, 1 << 64))

    def slices(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._tables(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.power[: len(values)], out=sums[1:])
        return _mixed((sums[ends] - sums[starts]) * self.inverse[starts])

    def runs(self, words: np.ndarray, langs: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the runs of ``size`` words at ``starts``, different for each size and language."""
        found = self.slices(words, starts, starts + size)
        salt = np.uint64(int(self.salts[0]) * size % (1 << 64))
        return _mixed(found + salt + langs[starts] * (self.salts[1] | np.uint64(1)))


def _polynomials() -> tuple[Polynomial, Polynomial]:
    return Polynomial(1), Polynomial(2)


def prints_of(polynomials, hashes, langs: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and checks of the runs of ``size`` words at ``starts``."""
    prints, checks = (p.runs(h, langs, starts, size) for p, h in zip(polynomials, hashes, strict=True))
    return prints >> np.uint64(64 - PRINT_BITS), (checks >> np.uint64(64 - CHECK_BITS)).astype(np.uint32)


def strips(text: bytes):
    """A text in parts of about ``STRIP`` bytes that end behind a byte outside words."""
    at = 0
    while at < len(text):
        size = STRIP
        while at + size < len(text):
            outside = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, size, at)])
            if len(outside):
                size = int(outside[-1]) + 1
                break
            size *= 2
        yield text[at : at + size]
        at += size


def split_words(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """Starts and ends of words, whether a piece ended since the word before, and whether one ended behind the last word."""
    kind = _KIND[text]
    inside = np.zeros(len(text) + 2, np.int8)
    inside[1:-1] = kind == 0
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    breaks = np.zeros(len(text) + 1, np.int64)
    np.cumsum(kind == 2, out=breaks[1:])
    passed = breaks[starts]
    return starts, ends, np.diff(passed, prepend=0) > 0, bool(breaks[-1] > (passed[-1] if len(passed) else 0))


def _slices(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of slices of ``text``, one slice behind the other."""
    ends = np.cumsum(lengths)
    return text[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


class Block:
    """Word hashes of many texts, in order, with what their runs need; ``spelled`` ones hold the words, too."""

    def __init__(self, first: Polynomial, second: Polynomial, spelled: bool = False):
        self.polynomials, self.parts, self.words, self.spelled, self.spelling = (first, second), [], 0, spelled, []

    def add(self, text: bytes, numbers: np.ndarray, langs: np.ndarray, begins: np.ndarray, broken: bool) -> bool:
        """Take the words of ``text``, whose parts with these numbers and languages begin at ``begins``; returns whether a
        piece ended behind the last."""
        values = _LOWER[np.frombuffer(text, np.uint8)]
        starts, ends, apart, after = split_words(values)
        if not len(starts):
            return broken or after
        apart[0] |= broken
        hashes = [p.slices(p.of_byte[values], starts, ends) for p in self.polynomials]
        owner = np.searchsorted(begins, starts, side="right") - 1
        self.parts.append((*hashes, apart, langs[owner], numbers[owner]))
        self.words += len(starts)
        if self.spelled:
            values = np.append(values, np.uint8(32))
            values[ends] = 32
            taken = np.append(_KIND[values[:-1]] == 0, False)
            taken[ends] = True
            self.spelling.append((values[taken], ends - starts))
        return after

    def spell(self) -> None:
        """Join what was added: the words with one space behind each, where they start, their lengths and numbers."""
        self.text, self.lengths = (np.concatenate(c) for c in zip(*self.spelling, strict=True))
        self.numbers = np.concatenate([p[4] for p in self.parts])
        self.starts = np.cumsum(self.lengths + 1) - self.lengths - 1

    def alike(self, places: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Whether the words at ``places`` have the bytes and the numbers of the ``others``."""
        n = self.lengths[places]
        same = (self.numbers[places] == self.numbers[others]) & (n == self.lengths[others])
        left = np.flatnonzero(same & (places != others))
        passed = np.cumsum(n[left])
        for part in np.split(left, np.searchsorted(passed, np.arange(STRIP, passed[-1] if len(left) else 0, STRIP))):
            if len(part):
                differ = _slices(self.text, self.starts[places[part]], n[part]) != _slices(self.text, self.starts[others[part]], n[part])
                if differ.any():
                    same[part] = ~np.logical_or.reduceat(differ, np.cumsum(n[part]) - n[part])
        return same

    def groups(self, longest: int):
        """``(size, places, new, prints, checks)`` for each size: the first words of all runs in order of print and check,
        where in it other ones begin, and those prints and checks."""
        first, second, apart, langs = (np.concatenate(c) for c in list(zip(*self.parts, strict=True))[:4])
        pieces = np.cumsum(apart)
        for size in range(1, longest + 1):
            last = len(first) - size + 1
            if last < 1:
                continue
            at = np.flatnonzero(pieces[size - 1 :] == pieces[:last])
            prints, checks = prints_of(self.polynomials, (first, second), langs, at, size)
            order = np.argsort(prints, kind="stable")
            ordered, beside = prints[order], checks[order]
            if ((ordered[1:] == ordered[:-1]) & (beside[1:] != beside[:-1])).any():
                order = np.lexsort((checks, prints))
                ordered, beside = prints[order], checks[order]
            new = np.flatnonzero(np.append(True, (ordered[1:] != ordered[:-1]) | (beside[1:] != beside[:-1])))[: len(order)]
            yield size, at[order], new, ordered[new], beside[new]

    def entries(self, longest: int):
        """``(size, print, check, count, place)`` arrays, sorted by print and check, for each size."""
        for size, places, new, prints, checks in self.groups(longest):
            yield size, prints, checks, np.diff(new, append=len(places)).astype(np.uint32), places[new]


def _lang_code(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _pack(batches):
    """The texts of a task in blocks: their languages, where each one's text ends in the joined one, and its words."""
    schema = pa.schema([("langs", pa.list_(pa.string())), ("ends", pa.list_(pa.int64())), ("words", pa.list_(pa.int64())), ("text", pa.binary())])

    def block():
        joined = [b"\n".join(texts) for texts in waiting.values()]
        text = packed(np.frombuffer(b"".join(joined), np.uint8))
        columns = list(waiting), np.cumsum([len(t) for t in joined]).tolist(), [words[x] for x in waiting], text
        return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    waiting, words, n, held = {}, {}, 0, 0
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not text:
                continue
            found = (b" " + text.translate(_MARKED)).count(b" x")
            waiting.setdefault(lang, []).append(text)
            words[lang] = words.get(lang, 0) + found
            n, held = n + found, held + len(text)
            if n >= BLOCK_WORDS or held >= BLOCK_BYTES:
                yield block()
                waiting, words, n, held = {}, {}, 0, 0
    if waiting:
        yield block()


def _block(row: dict, spelled: bool = False) -> Block:
    """The words of a packed block; its languages are numbered as they stand."""
    block, start = Block(*_polynomials(), spelled), 0
    text = unpacked(row["text"], np.uint8, row["ends"][-1]).tobytes()
    for number, (lang, end) in enumerate(zip(row["langs"], row["ends"], strict=True)):
        broken = True
        for part in strips(text[start:end]):
            broken = block.add(part, np.array([number], np.int32), np.array([_lang_code(lang)], np.uint64), np.zeros(1, np.int64), broken)
        start = end
    return block


def _cuts(prints: np.ndarray, owners: int) -> list[int]:
    """Where the entries of each owner begin in sorted prints, and the end."""
    bounds = np.array([-(-(o << SENT_BITS) // owners) for o in range(owners)], np.uint64)
    return [*np.searchsorted(_sent(prints), bounds).tolist(), len(prints)]


def _sent(prints: np.ndarray) -> np.ndarray:
    return prints >> np.uint64(PRINT_BITS - SENT_BITS)


def _send(owners: int, longest: int):
    kinds = pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()
    names = [field.split()[0] for field in MESSAGE.split(", ")]

    def send(batches):
        """Blocks in, their entries out, a message for each size and owner."""
        for batch in batches:
            for row in range(batch.num_rows):
                packed_block, rows = batch.slice(row, 1).to_pylist()[0], []
                block = _block(packed_block)
                for size, prints, _, counts, _ in block.entries(longest) if block.words else ():
                    cuts = _cuts(prints, owners)
                    for owner, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        if end > start:
                            part = slice(start, end)
                            rows.append((owner, packed_block["block"], size, end - start, packed(gaps(_sent(prints[part]))), packed(counts[part])))
                for at in range(0, len(rows), 64):
                    columns = zip(*rows[at : at + 64], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return send


def _add_up(least: int):
    def add_up(table: pa.Table) -> pa.Table:
        """One owner: all blocks' entries in, and for each message out which of them all blocks together have often enough."""
        messages, out = {}, []
        for r in table.to_pylist():
            prints, counts = np.cumsum(unpacked(r["prints"], np.uint64, r["n"])), unpacked(r["counts"], np.uint32, r["n"])
            messages.setdefault(r["size"], []).append(((r["block"], r["size"], r["owner"], r["n"]), prints, counts))
        for size in list(messages):
            heads, prints, counts = zip(*messages.pop(size), strict=True)
            prints, counts = np.concatenate(prints), np.concatenate(counts)
            order = np.argsort(prints, kind="stable")
            ordered = prints[order]
            new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
            totals = np.add.reduceat(counts[order].astype(np.int64), new)
            often = np.zeros(len(prints), bool)
            often[order] = np.repeat(totals >= least, np.diff(new, append=len(order)))
            parts = np.split(often, np.cumsum([h[3] for h in heads])[:-1])
            out += [(*h, np.packbits(part).tobytes()) for h, part in zip(heads, parts, strict=True) if part.any()]
        columns = list(zip(*out, strict=True)) or [[]] * 5
        kinds = pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[field.split()[0] for field in REPLY.split(", ")])

    return add_up


def _parted(groups: np.ndarray, same: np.ndarray, key) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers after each member unlike the first of its group went to a new group of its key; where these begin."""
    groups, found, begins = groups.copy(), {}, []
    fresh = int(groups.max(initial=-1)) + 1
    for k in np.flatnonzero(~same).tolist():
        name = key(k)
        if name not in found:
            found[name] = fresh + len(found)
            begins.append(k)
        groups[k] = found[name]
    return groups, np.array(begins, np.int64)


def frequent_runs(block: Block, answers: dict[tuple[int, int], np.ndarray], owners: int, longest: int):
    """``(size, places, counts, owners)`` of the runs that the answers, by size and owner, leave, told apart by their words."""
    names = np.zeros(block.words, np.int64)
    block.spell()
    for size, places, new, prints, _ in block.groups(longest):
        cuts = _cuts(prints, owners)
        often = np.zeros(len(new), bool)
        for owner, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if (size, owner) in answers:
                often[start:end] = answers[size, owner]
        groups = np.repeat(np.arange(len(new)), np.diff(new, append=len(places)))
        if size == 1:
            firsts = places[new][groups]

            def word(k: int, places=places) -> tuple[int, bytes]:
                start = block.starts[places[k]]
                return int(block.numbers[places[k]]), block.text[start : start + block.lengths[places[k]]].tobytes()

            parted, begins = _parted(groups, block.alike(places, firsts), word)
            names[places] = parted
            kept, entries = np.arange(len(places)), np.arange(len(new))
        else:
            kept, entries = np.flatnonzero(often[groups]), np.flatnonzero(often)
            firsts = places[new][groups[kept]]
            words = [names[places[kept] + j] for j in range(size)]
            same = np.logical_and.reduce([w == names[firsts + j] for j, w in enumerate(words)])
            parted, begins = _parted((np.cumsum(often) - 1)[groups[kept]], same, lambda k, words=words: tuple(int(w[k]) for w in words))
        heads = np.append(entries, groups[kept[begins]])
        counts, firsts = np.bincount(parted, minlength=len(heads)), np.append(places[new[entries]], places[kept[begins]])
        wanted = often[heads]
        yield size, firsts[wanted], counts[wanted], np.searchsorted(cuts, heads[wanted], side="right") - 1


def _spell(owners: int, readers: int, longest: int):
    names = [field.split()[0] for field in SPELLED.split(", ")]
    kinds = pa.int32(), pa.int64(), pa.list_(pa.string()), *[pa.binary()] * 5

    def spell(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        """A block and its answers in; out, for each owner of texts, the runs that can be frequent, with their counts."""
        answers = {(r["size"], r["owner"]): np.unpackbits(np.frombuffer(r["bits"], np.uint8), count=r["n"]).astype(bool) for r in replies.to_pylist()}
        out = []
        for row in blocks.to_pylist() if answers else ():
            block, parts = _block(row, spelled=True), []
            for size, places, counts, owner in frequent_runs(block, answers, owners, longest):
                last = places + size - 1
                lengths = block.starts[last] + block.lengths[last] - block.starts[places]
                parts.append((owner * readers // owners, np.full(len(places), size), places, counts, lengths))
            reader, sizes, places, counts, lengths = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.argsort(reader, kind="stable")
            cuts = np.flatnonzero(np.diff(reader[order])) + 1
            for part in np.split(order, cuts) if len(order) else ():
                used, which = np.unique(block.numbers[places[part]], return_inverse=True)
                columns = (packed(c.astype(np.uint32)) for c in (which, sizes[part], counts[part], lengths[part]))
                text = packed(_slices(block.text, block.starts[places[part]], lengths[part]))
                out.append((int(reader[part[0]]), len(part), [row["langs"][k] for k in used.tolist()], *columns, text))
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return spell


def _count(least: int):
    def count(table: pa.Table) -> pa.Table:
        """One owner of texts: equal texts of a language are added up, the frequent ones go out."""
        langs, parts = {}, []
        for r in table.to_pylist():
            which, sizes, counts, lengths = (unpacked(r[c], np.uint32, r["n"]) for c in ("which", "sizes", "counts", "lengths"))
            numbers = np.array([langs.setdefault(x, len(langs)) for x in r["langs"]], np.int32)
            ends = np.append(0, np.cumsum(lengths, dtype=np.int64))
            buffers = [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(unpacked(r["text"], np.uint8, int(ends[-1])))]
            phrases = pa.Array.from_buffers(pa.binary(), r["n"], buffers)
            parts.append(pa.table([numbers[which], phrases, sizes.astype(np.int32), counts.astype(np.int64)], ["number", "phrase", "size", "count"]))
        found = pa.concat_tables(parts).group_by(["number", "phrase", "size"], use_threads=False).aggregate([("count", "sum")])
        found = found.filter(pc.greater_equal(found["count_sum"], least))
        lang = pc.take(pa.array(list(langs), pa.string()), found["number"])
        return pa.table([lang, found["phrase"], found["size"], found["count_sum"]], ["lang", "phrase", "size", "total"])

    return count


def _overlapping(text: bytes, longest: int):
    """The strips of a text, each behind the last words of the one before, so that every run of words lies in one; the
    counting does not need it, as a block joins the words of its strips."""
    tail = b""
    for part in strips(text):
        yield tail + part
        starts, _, _, _ = split_words(np.frombuffer(tail + part, np.uint8))
        tail = (tail + part)[starts[-(longest - 1)] if len(starts) >= longest > 1 else 0 if longest > 1 else len(tail + part) :]


def frequent_phrases(docs: DataFrame, least: int, longest: int, lang: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, total)`` of every run of up to ``longest`` words met ``least`` times, and ``(lang, n)``."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    blocks = durable(rows.mapInArrow(_pack, PACKED).withColumn("block", F.monotonically_increasing_id()))
    size = blocks.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    owners = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // OWNER_BYTES + 1)
    readers = -(-owners // OWNERS_BESIDE)
    sent = blocks.select("block", "langs", "ends", "text").mapInArrow(_send(owners, longest), MESSAGE)
    replies = durable(sent.groupBy("owner").applyInArrow(_add_up(least), REPLY))
    forget(docs.sparkSession)
    spelled = blocks.drop("words").groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_spell(owners, readers, longest), SPELLED)
    phrases = durable(spelled.groupBy("owner").applyInArrow(_count(least), FOUND).withColumn("phrase", F.col("phrase").cast("string")))
    words = durable(blocks.select(F.explode(F.arrays_zip("langs", "words")).alias("of")).groupBy(F.col("of.langs").alias("lang")).agg(F.sum("of.words").alias("n")))
    release(blocks, replies)
    forget(docs.sparkSession)
    return phrases, words


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, key: str = "doc_id", lang: str = "lang", text: str = "text"
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of each language.

    Words are what stands between spaces and tabs within pieces, which end at ``.,;:!?`` and line ends; A-Z are lower-cased.
    ``a`` counts the phrase within pieces, overlaps included, ``l`` and ``r`` the parts at the cut with the lowest score, of
    equal ones the first, ``n`` all words of the language. A phrase inside a longer frequent one that has at least half
    its count is left out. Equal scores go by ``a``, then by phrase in UTF-8 order. A null lang counts as 'und', a null
    text as empty; texts of any length are hashed in strips. Ids are not read (``key``): they may be null or repeated, and
    repeated rows count each. Other columns play no part; an empty table gives an empty result. Products are exact up to counts of 10^15.
    """
    phrases, words = frequent_phrases(docs, least, longest, lang, text)
    parts = phrases.select("lang", "phrase", "total")
    several = phrases.where("size > 1").withColumn("words", F.split("phrase", " ")).withColumnRenamed("total", "a")
    cuts = several.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size - 1)")).alias("k")).select(
        "lang", "phrase", "a", "k", F.expr("array_join(slice(words, 1, k), ' ')").alias("left"),
        F.expr("array_join(slice(words, k + 1, size(words) - k), ' ')").alias("right"),
    )
    both = cuts.join(parts.toDF("lang", "left", "l"), ["lang", "left"]).join(parts.toDF("lang", "right", "r"), ["lang", "right"])
    score = F.expr("(1000000 * CAST(a AS DECIMAL(16, 0)) * CAST(a AS DECIMAL(16, 0))) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    scored = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = several.select("lang", "words", "size", "a", F.explode(F.expr("sequence(2, size - 1)")).alias("m")).where("m >= 2 AND m < size")
    inner = inner.select("lang", "a", F.explode(F.expr("transform(sequence(1, size - m + 1), i -> array_join(slice(words, i, m), ' '))")).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    free = scored.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("longer"), F.lit(0)) * INSIDE[0] < F.col("a") * INSIDE[1]
    ).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = top_k_per_group(free, "lang", top, F.desc("score"), F.desc("a"), F.asc("phrase"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
