"""Personal data: fixed patterns, and words that give a protected value away, in DataFrame functions alone.

The corpus tells how much a word near a protected value reveals of it. With ``N`` documents, ``n(e)`` of them with the
value, ``n(t)`` with the word and ``n(t, e)`` with both side by side, the value's information is ``log2(N / n(e))`` and the word
discloses ``log2(N n(t, e) / (n(t) n(e)))`` of it. A word that stands near a value in at least ``SUPPORT`` different contexts and
discloses at least ``SHARE`` of its information is marked there, and generalised by ``sanitise``. Copies of one context count
once as support.

Patterns are written so that the engine's matching takes time in proportion to the text: possessive repeats, and a
match starts only where a run starts or the last match ended. Places are summed and texts cut in blocks, so a long text
with many values takes time in proportion to both, not to their product.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.names import fresh
from shelfwise.session import durable

SUPPORT = 3
SHARE = 0.8
REACH = 80
BROADCAST_ROWS = 200_000
SCAN_BLOCK, TEXT_BLOCK = 256, 4096

#: The four kinds of protected values, in their order.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?=[0-9])(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WORD = r"\p{L}{4,}+"
TERM = len(KINDS)
_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once; a column named inside a lambda would be computed anew for every element."""
    return F.get(F.transform(F.array(value), body), 0)


def _scan(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """What ``merge`` makes of each number and all before it (from 0), in blocks, so that no step copies a long array."""
    none = F.array().cast("array<int>")

    def inside(block: Column, before: Column) -> Column:
        def step(acc: Column, value: Column) -> Column:
            return _bound(merge(acc["at"], value), lambda at: F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out")))

        return F.aggregate(block, F.struct(before.alias("at"), none.alias("out")), step)

    def across(acc: Column, block: Column) -> Column:
        done = inside(block, acc["at"])
        return _bound(done, lambda d: F.struct(d["at"].alias("at"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

    starts = F.sequence(F.lit(1), F.size(values), F.lit(SCAN_BLOCK))
    blocks = F.transform(starts, lambda k: F.slice(values, k, SCAN_BLOCK))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("out"))
    return F.when(F.size(values) > 0, F.aggregate(blocks, start, across, lambda acc: F.flatten(acc["out"]))).otherwise(none)


def matches(text: Column, pattern: str, kind: int) -> Column:
    """``(start, kind, end, value)`` of all matches, in code points; the gaps between matches give the places."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def spans(m: Column) -> Column:
        steps = F.zip_with(m["found"], F.slice(m["gaps"], F.lit(1), F.size(m["found"])), lambda f, g: F.length(f) + F.length(g))
        ends = _bound(steps, lambda x: _scan(x, lambda before, step: before + step))
        return F.zip_with(
            m["found"], ends, lambda f, e: F.struct((e - F.length(f)).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), f.alias("value"))
        )

    none = F.array().cast(_SPANS)
    return _bound(
        found, lambda f: F.when(F.size(f) > 0, _bound(F.struct(f.alias("found"), gaps.alias("gaps")), spans)).otherwise(none)
    )


def _blocks(text: Column) -> Column:
    """The text in blocks of ``TEXT_BLOCK`` code points; a place in a long text is then found without reading all before it."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))


def _part(blocks: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` of a text in blocks; empty where they are none."""

    def piece(b: Column) -> Column:
        first = F.greatest(start - b * TEXT_BLOCK, F.lit(0))
        return F.substring(F.get(blocks, b), first + 1, end - b * TEXT_BLOCK - first)

    inside = F.sequence((start / TEXT_BLOCK).cast("int"), ((end - 1) / TEXT_BLOCK).cast("int"))
    return F.when(end > start, F.array_join(F.transform(inside, piece), "")).otherwise("")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))

    def step(total: Column, k: Column) -> Column:
        digit = F.substring(digits, k, F.lit(1)).cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(k % 2 == 0, double).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _small_parts(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def base_spans(text: Column) -> Column:
    """The protected values of a text by start, then kind as listed."""
    none = F.array().cast(_SPANS)
    email = F.when(F.contains(text, F.lit("@")), matches(text, PATTERNS["email"], 0)).otherwise(none)
    ip = F.filter(matches(text, PATTERNS["ip"], 1), lambda s: _small_parts(s["value"]))
    card = F.filter(matches(text, PATTERNS["card"], 2), lambda s: _luhn(s["value"]))
    phone = F.filter(matches(text, PATTERNS["phone"], 3), lambda s: F.length(_digits(s["value"])).between(10, 15))
    phone = F.when(F.contains(text, F.lit("+")), phone).otherwise(none)
    numbers = F.when(text.rlike("[0-9]"), F.concat(ip, card, phone)).otherwise(none)
    return F.array_sort(F.concat(email, numbers))


def _contexts(text: Column, spans: Column) -> Column:
    """For each value: itself, and the words of at least four letters within ``REACH`` of it, with their places."""

    def moved(words: Column, by: Column) -> Column:
        return F.transform(words, lambda w: F.struct(F.lower(w["value"]).alias("word"), (w["start"] + by).alias("start"), (w["end"] + by).alias("end")))

    def near(span: Column, blocks: Column) -> Column:
        first = F.greatest(span["start"] - REACH, F.lit(0))
        entity = F.concat(F.get(F.array(*map(F.lit, KINDS)), span["kind"]), F.lit(":"), F.lower(span["value"]))

        def around(s: Column) -> Column:
            before = F.filter(matches(s["left"], WORD, TERM), lambda w: (w["start"] > 0) | (first == 0))
            after = F.filter(matches(s["right"], WORD, TERM), lambda w: w["end"] < REACH)
            words = F.concat(moved(before, first), moved(after, span["end"]))
            return F.struct(entity.alias("entity"), F.xxhash64(s["left"], s["right"]).alias("context"), words.alias("words"))

        left, right = _part(blocks, first, span["start"]), _part(blocks, span["end"], span["end"] + REACH)
        return _bound(F.struct(left.alias("left"), right.alias("right")), around)

    return F.when(F.size(spans) > 0, _bound(_blocks(text), lambda blocks: F.transform(spans, lambda span: near(span, blocks))))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def find_values(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, print, spans, contexts)``, written once; ``print`` tells apart texts under one id."""
    spans = _rows(docs, key, text).select("doc_id", F.xxhash64("text").alias("print"), "text", base_spans(F.col("text")).alias("spans"))
    return durable(spans.select("doc_id", "print", "spans", _contexts(F.col("text"), F.col("spans")).alias("contexts")))


def revealing_words(docs: DataFrame, values: DataFrame, support: int, share: float, key: str, text: str) -> DataFrame:
    """``(entity, word)`` pairs that disclose at least ``share`` of the entity's information."""
    near = values.select("doc_id", "print", F.explode("contexts").alias("c")).select("doc_id", "print", "c.entity", "c.context", "c.words")
    entity_docs = near.select("entity", "doc_id", "print").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    words = near.select("doc_id", "print", "entity", "context", F.explode("words.word").alias("word")).distinct()
    contexts = words.select("entity", "word", "context").distinct().groupBy("entity", "word").agg(F.count(F.lit(1)).alias("n_c")).where(F.col("n_c") >= support)
    together = words.select("entity", "word", "doc_id", "print").distinct().groupBy("entity", "word").agg(F.count(F.lit(1)).alias("n_te"))
    pairs = durable(contexts.join(together, ["entity", "word"]).join(entity_docs, "entity"))
    spoken = _rows(docs, key, text).select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))).alias("word"))
    frequency = spoken.groupBy("word").agg(F.count(F.lit(1)).alias("n_t"))
    n = F.lit(float(values.count()))
    disclosed = F.log2(n * F.col("n_te") / F.col("n_t") / F.col("n_e"))
    information = F.log2(n / F.col("n_e"))
    return pairs.join(frequency, "word").where((information > 0) & (disclosed >= share * information)).select("entity", "word")


def term_spans(docs: DataFrame, values: DataFrame, support: int = SUPPORT, share: float = SHARE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, print, terms)``: the places of revealing words beside the values they reveal."""
    found = revealing_words(docs, values, support, share, key, text)
    near = values.select("doc_id", "print", F.explode("contexts").alias("c")).select("doc_id", "print", "c.entity", F.explode("c.words").alias("w"))
    places = near.select("doc_id", "print", "entity", F.col("w.word").alias("word"), F.col("w.start").alias("start"), F.col("w.end").alias("end"))
    span = F.struct("start", F.lit(TERM).alias("kind"), "end", F.col("word").alias("value"))
    return places.join(found, ["entity", "word"]).groupBy("doc_id", "print").agg(F.collect_set(span).alias("terms"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, (*KINDS, "term")))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _beside(left: DataFrame, terms: DataFrame) -> DataFrame:
    other = terms.select(F.col("doc_id").alias("_id"), F.col("print").alias("_print"), F.col("terms").alias("_terms"))
    return left.join(other, left["doc_id"].eqNullSafe(other["_id"]) & (left["print"] == other["_print"]), "left")


def find_personal_data(docs: DataFrame, support: int = SUPPORT, share: float = SHARE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans)``, a row for each row of ``docs``.

    Null and empty texts have no spans. Repeated rows are repeated in the result. Other columns play no part; an empty
    table gives an empty result.
    """
    values = find_values(docs, key, text)
    rows = _beside(values.select("doc_id", "print", "spans"), term_spans(docs, values, support, share, key, text))
    spans = F.array_sort(F.concat("spans", F.coalesce("_terms", F.array().cast(_SPANS))))
    kinds = F.transform(spans, lambda s: s["kind"])
    count = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{name}") for kind, name in enumerate((*KINDS, "term"))
    ]
    return rows.select("doc_id", *count, F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"), _listed(spans).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or chain of overlapping ones, as the label of the first; ``spans`` are sorted."""
    labels = F.array(*(F.lit(f"[{name.upper()}]") for name in (*KINDS, "term")))

    def replaced(x: Column) -> Column:
        def piece(span: Column, reached: Column) -> Column:
            return F.when(span["start"] >= reached, F.concat(_part(x["blocks"], reached, span["start"]), F.get(labels, span["kind"]))).otherwise("")

        before = F.slice(F.concat(F.array(F.lit(0)), x["reached"]), F.lit(1), F.size(x["spans"]))
        last = _part(x["blocks"], F.element_at(x["reached"], -1), x["n"])
        return F.concat(F.array_join(F.zip_with(x["spans"], before, piece), ""), last)

    def whole(s: Column) -> Column:
        reached = _bound(F.transform(s, lambda x: x["end"]), lambda ends: _scan(ends, F.greatest))
        return _bound(F.struct(s.alias("spans"), reached.alias("reached"), _blocks(text).alias("blocks"), F.length(text).alias("n")), replaced)

    return _bound(spans, lambda s: F.when(F.size(s) > 0, whole(s)).otherwise(text))


def sanitise(docs: DataFrame, support: int = SUPPORT, share: float = SHARE, key: str = "doc_id", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """``docs`` with protected values and revealing words generalised to labels; all rows and columns stay.

    ``chars``, where present, is counted anew. A null text stays null.
    """
    values = find_values(docs, key, text)
    terms = durable(term_spans(docs, values, support, share, key, text))
    if terms.count() <= BROADCAST_ROWS:
        terms = F.broadcast(terms)
    own_id, own_print, own_terms, clean = fresh(docs, "id", "print", "terms", "clean")
    other = terms.select(F.col("doc_id").alias(own_id), F.col("print").alias(own_print), F.col("terms").alias(own_terms))
    body = F.col(text).cast("string")
    rows = docs.join(other, docs[key].cast("long").eqNullSafe(other[own_id]) & (F.xxhash64(F.coalesce(body, F.lit(""))) == other[own_print]), "left")
    spans = F.array_sort(F.concat(base_spans(body), F.coalesce(own_terms, F.array().cast(_SPANS))))
    rows = rows.withColumn(clean, redacted(body, spans))
    columns = {text: F.col(clean), chars: F.length(clean).cast("long")}
    return rows.select(*(columns.get(c, F.col(c)).alias(c) for c in docs.columns))
