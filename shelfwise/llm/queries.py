"""The queries of the training-data operators, each over its whole table, and their SQL where there is any."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from shelfwise.llm import byte_bpe, collocations, divergence, exact_dedup, html_text, licences, near_join, packing, pii, quality, secrets, suffix_dedup, url_filter

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = packing.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))
    return packing.pack(found)


def captures_and_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Pages fetched when the event of the same number happened, and a list log: every event but a view adds (errors and
    purchases) or removes an entry for the page that its user number names: its host, its registered domain or its first
    path part, in turn."""
    pages, events = _table(spark, sf_dir, "pages"), _table(spark, sf_dir, "events")
    captures = pages.select("page_id", "url").join(events.select(F.col("event_id").alias("page_id"), "ts"), "page_id", "left")
    host = url_filter.host(F.col("url"))
    named = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("host:"), host))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit("domain:"), F.regexp_extract(host, r"([^.]+[.][^.]+)$", 1)))
        .otherwise(F.concat(F.lit("prefix:"), host, F.lit("/"), F.regexp_extract(url_filter.path(F.col("url")), "^/([^/]+)", 1), F.lit("/")))
    )
    changes = events.where("event_type <> 'view'").select("event_id", "ts", F.col("user_id").alias("page_id"), F.col("event_type").isin("error", "purchase").alias("active"))
    return captures, changes.join(pages.select("page_id", "url"), "page_id").select(named.alias("entry"), "ts", "active")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.evaluate(*captures_and_log(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(_table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(_table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    f.__name__: f
    for f in (op1_exact_dedup, op2_packing, op3_url_filter, op4_secrets, op5_byte_bpe, op6_pii, op7_jaccard_join, op8_licences, op9_quality, op10_html_text,
              op11_suffix_dedup, op12_collocations, op13_divergence)
} | {"pipeline": corpus_pipeline.run}

_URL = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(?::[0-9]*)?(/[^?#]*)?"

LLM_ORACLES = {
    "op1_exact_dedup": r"""
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        WINDOW w AS (PARTITION BY norm)
        """,
    "op3_url_filter": rf"""
        WITH p AS (
          SELECT page_id, url, lower(regexp_extract(url, '{_URL}', 1)) AS h,
            list_filter(string_split(regexp_extract(url, '{_URL}', 2), '/'), lambda x: x <> '') AS parts FROM pages),
        raw AS (
          SELECT CASE e.event_id % 3 WHEN 0 THEN 'host:' || h WHEN 1 THEN 'domain:' || regexp_extract(h, '([^.]+[.][^.]+)$', 1)
            ELSE 'prefix:' || h || '/' || coalesce(parts[1], '') || '/' END AS entry, e.ts, e.event_type IN ('error', 'purchase') AS active
          FROM events e JOIN p ON p.page_id = e.user_id WHERE e.event_type <> 'view'),
        log AS (SELECT entry, ts, bool_and(active) AS active FROM raw GROUP BY entry, ts),
        c AS (SELECT p.*, e.ts, string_split(h, '.') AS labels FROM p LEFT JOIN events e ON e.event_id = p.page_id),
        cand AS (
          SELECT DISTINCT url, ts, entry FROM (
            SELECT url, ts, 'host:' || h AS entry FROM c UNION ALL
            SELECT url, ts, 'domain:' || array_to_string(labels[k:], '.') FROM c, unnest(range(1, len(labels) + 1)) AS t(k) UNION ALL
            SELECT url, ts, 'prefix:' || h || '/' || array_to_string(parts[1:k], '/') || '/' FROM c, unnest(range(1, len(parts) + 1)) AS t(k))
          WHERE ts IS NOT NULL),
        act AS (
          SELECT cand.url, cand.ts, cand.entry, log.ts AS since FROM cand ASOF JOIN log ON cand.entry = log.entry AND cand.ts >= log.ts WHERE log.active),
        best AS (
          SELECT url, ts, count(*) AS n, arg_min(entry, (-length(entry), entry)) AS entry, arg_min(since, (-length(entry), entry)) AS since
          FROM act GROUP BY url, ts)
        SELECT c.page_id, c.url, c.ts, coalesce(n, 0) AS n_active, best.entry, best.since FROM c LEFT JOIN best ON best.url = c.url AND best.ts = c.ts
        """,
    "op11_suffix_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS nr, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        s AS (SELECT nr, doc_id, p, substring(h, 2 * p + 1, 100) AS w FROM (
          SELECT nr, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS p FROM d WHERE doc_id IS NOT NULL)),
        k AS (SELECT nr, p FROM (SELECT nr, p, doc_id, min(doc_id) OVER (PARTITION BY w) AS first FROM s) WHERE first < doc_id),
        g AS (SELECT nr, p, sum(new) OVER (PARTITION BY nr ORDER BY p) AS run FROM (
          SELECT nr, p, CASE WHEN p <= lag(p) OVER (PARTITION BY nr ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM k)),
        r AS (SELECT nr, run, min(p) AS a, max(p) + 50 AS b FROM g GROUP BY nr, run),
        e AS (SELECT nr, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends, sum(b - a)::BIGINT AS removed, count(*) AS spans FROM r GROUP BY nr)
        SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
          sha256(unhex(CASE WHEN spans IS NULL THEN h ELSE array_to_string(list_transform(range(0, spans + 1), lambda i:
            substring(h, CASE WHEN i = 0 THEN 1 ELSE 2 * ends[i] + 1 END,
              CASE WHEN i = spans THEN len(h) ELSE 2 * starts[i + 1] END - CASE WHEN i = 0 THEN 0 ELSE 2 * ends[i] END)), '') END)) AS kept_sha256
        FROM d LEFT JOIN e USING (nr)
        """,
    "op12_collocations": r"""
        WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
        pieces AS (SELECT row, lang, unnest(string_split_regex(low, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        numbered AS (SELECT lang, row_number() OVER () AS nr, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces),
        w AS (SELECT lang, nr, unnest(words) AS word, unnest(range(len(words))) AS i FROM numbered),
        n AS (SELECT lang, count(*) AS n FROM w GROUP BY lang),
        g AS (SELECT lang, word, lead(word, 1) OVER o AS second, lead(word, 2) OVER o AS third FROM w WINDOW o AS (PARTITION BY nr ORDER BY i)),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM (
            SELECT lang, 1 AS k, word AS phrase FROM g UNION ALL
            SELECT lang, 2, word || ' ' || second FROM g WHERE second IS NOT NULL UNION ALL
            SELECT lang, 3, word || ' ' || second || ' ' || third FROM g WHERE third IS NOT NULL)
          GROUP BY lang, k, phrase HAVING count(*) >= 10),
        c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS words FROM f WHERE k > 1),
        cut AS (SELECT c.lang, c.phrase, c.a, j, l.a AS l, r.a AS r, ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
          FROM (SELECT c.*, j, array_to_string(words[1:j], ' ') AS lp, array_to_string(words[j + 1:], ' ') AS rp FROM c, range(1, 3) AS t(j) WHERE j < k) c
          JOIN f l ON l.lang = c.lang AND l.phrase = lp JOIN f r ON r.lang = c.lang AND r.phrase = rp),
        low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        part AS (SELECT lang, array_to_string(words[i:i + 1], ' ') AS phrase, max(a) AS a FROM c, range(1, 3) AS t(i) WHERE k = 3 GROUP BY ALL),
        free AS (SELECT low.* FROM low LEFT JOIN part p ON p.lang = low.lang AND p.phrase = low.phrase WHERE p.a IS NULL OR 100 * p.a < 50 * low.a)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
        FROM free JOIN n USING (lang) QUALIFY rank <= 2000
        """,
    "op13_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
        t AS (SELECT row, lang, source, unnest(regexp_extract_all(low, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS n FROM kept GROUP BY lang),
        s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::BIGINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
        p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (s.n + v.v) AS p,
              1 + 1000000000 * (k.n + 1) // (v.n + v.v) AS q
            FROM s JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
        pair AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) x
            ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
        every AS (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL
          SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
        FROM every QUALIFY part = 'pair' OR rank <= 200
        """,
}
if corpus_pipeline.ORACLE_SQL:
    LLM_ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
