"""The pipeline, stage by stage and as a whole, against plain Python."""

import re

import duckdb
import public_tokenizers
import pytest
from test_operators import _no_gaps, brute_classes, personal

import corpus_pipeline
from shelfwise.llm import packing, quality
from shelfwise.llm.queries import LLM_ORACLES, LLM_QUERIES

SMALL = "/root/testdata/sf0.001"


def test_names():
    assert [n.split("_")[0] for n in LLM_QUERIES] == [*(f"op{k}" for k in range(1, 14)), "pipeline"] and set(LLM_ORACLES) <= set(LLM_QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", [n for n in LLM_QUERIES if n not in ("pipeline", "op12_collocations", "op13_divergence")])
def test_every_query_gives_a_row_for_each_input_row(spark, name):
    table = "pages" if name.startswith(("op3_", "op10_")) else "documents"
    rows = LLM_QUERIES[name](spark, SMALL)
    key = rows.columns[0]
    assert rows.select(key).distinct().count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, model = docs.columns, quality.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    rows = {r[0]: r[1] for r in duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()}
    rows = {d: t for d, t in rows.items() if quality.verdict((t or "").encode(), model, quality.THRESHOLD)[6]}
    seen = set()
    for d in sorted(rows):
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", rows[d] or "")
        if norm in seen:
            del rows[d]
        seen.add(norm)
    rows = {d: rows[d] for d, c, _ in brute_classes(rows) if d == c}
    cleaned = {}
    for d, text in rows.items():
        out, at = "", 0
        for start, kind, end in personal(text):
            if end > at:
                out += text[at:start] + (f"[{('EMAIL', 'IP', 'CARD', 'PHONE')[kind]}]" if start >= at else "")
                at = end
        cleaned[d] = out + text[at:]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == columns
    found = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {d: re.sub(r"\[TERM\]", "", t) == t and t for d, t in found.items() if "[TERM]" not in t} == {d: t for d, t in cleaned.items() if "[TERM]" not in found[d]}
    assert set(found) == set(cleaned)
    packed = corpus_pipeline.run(spark, SMALL).collect()
    _no_gaps(packed)
    words = packing.WordCodes(public_tokenizers.path("word_bpe_49k.json"))
    assert sum(r["length"] for r in packed) == sum(len(words.codes(t.encode())) // 4 + 1 for t in found.values())
