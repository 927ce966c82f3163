"""The registered queries over whole test tables: against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import zlib

import corpus_pipeline
import duckdb
import pytest
from llm_helpers import SF_DIR, rows, tables  # noqa: F401
from pyspark.sql import functions as F
from test_neardup import brute
from test_packing import check
from test_spans_and_search import base, matched

from tradewinds.llm import packing, pii, queries
from tradewinds.llm.frames import stage

TABLES = "documents embeddings benchmark labels conversations"


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_against_sql(name, spark):
    db = duckdb.connect()
    for t in TABLES.split():
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    result = db.execute(queries.ORACLE_SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    columns = sorted(names)
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in result.fetchall()), key=repr)
    assert rows(df, *columns) == want


def test_contract_columns(spark):
    want = {
        "op1_pii": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
        "op2_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
                       "offset bigint",
        "op3_quality": "doc_id bigint, held_out boolean, score double, predicted int",
        "op6_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
        "op11_sentencepiece": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, agrees boolean",
        "op12_negatives": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
                          "negative_score bigint",
        "op13_merkle": "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                       "verified boolean",
        "op9_langid": "doc_id bigint, held_out boolean, lang_pred string, score double, rejected boolean",
    }
    for name, schema in want.items():
        got = queries.QUERIES[name](spark, SF_DIR)
        assert ", ".join(f"{c} {t}" for c, t in got.dtypes) == schema
        assert name in ("op2_packing", "op12_negatives") or got.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_base_digest_of_every_document(spark, tables):
    texts = {r.doc_id: r.text for r in tables("documents").collect()}
    for r in queries.op1_pii(spark, SF_DIR).collect():
        found = base(texts[r.doc_id] or "")
        line = ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert (r.n_email, r.n_card) == tuple(sum(s[2] == k for s in found) for k in ("email", "card"))
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_contaminated_documents(spark, tables):
    texts = {r.doc_id: r.text for r in tables("documents").collect()}
    items = {r.item_id: r.text for r in tables("benchmark").collect()}
    got = {r.doc_id: r.item_ids for r in queries.op4_decontamination(spark, SF_DIR).collect()}
    verbatim = {(d, i) for d, text in texts.items() for i, item in items.items() if item in (text or "")}
    assert verbatim and all(i in got.get(d, []) for d, i in verbatim)
    assert all(matched(texts[d], items[i]) for d, found in got.items() for i in found)


def test_pipeline_stage_by_stage(spark, tables):
    docs, kept = tables("documents"), {}
    columns = docs.columns
    for name, function in corpus_pipeline.STAGES:
        before, docs = docs, stage(function(spark, docs, SF_DIR), "pipeline")
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    labels = {r.doc_id: r.quality for r in tables("labels").collect()}
    good = {r.doc_id for r in kept["quality"][1].collect()}
    known = [(d, q) for d, q in labels.items() if zlib.crc32(str(d).encode()) % 3 == 1]
    assert sum((d in good) == (q == 1) for d, q in known) >= 0.95 * len(known)

    before, after = kept["near duplicates"]
    want = [i for i, _, _, keep in brute([(r.doc_id, r.text) for r in before.collect()]) if keep]
    assert rows(after, "doc_id") == sorted([(i,) for i in want], key=repr)

    before, after = kept["benchmark decontamination"]
    items = [r.text for r in tables("benchmark").collect()]
    clean = {r.doc_id for r in after.collect()}
    for r in before.collect():
        # Comparing every pair by brute force takes minutes; test_spans_and_search does so on a fixture.
        if r.doc_id in clean:
            assert not any(item in r.text for item in items)
        else:
            assert any(matched(r.text, item) for item in items)

    before, after = kept["personal data"]
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        assert base(texts[r.doc_id]) or "[SECRET]" in r.text or "[" in r.text or r.text == texts[r.doc_id]
    assert rows(after, "doc_id") == rows(before, "doc_id")

    before, after = kept["packing"]
    check(before, after, packing.SIZE)
    assert all(r.ids_crc32 == zlib.crc32(r.ids) for r in after.collect())


CLASHING = ("kept", "found", "text_hash", "__text", "__found", "component_id", "score", "predicted", "label", "spans", "ids")


def test_pipeline_odd_documents(spark, tables, tmp_path):
    """Nulls, empty and long texts, repeats, ids missing or repeated, and columns named like the stages' own."""
    some = tables("documents").select("doc_id", "text", "lang", "source", "n_chars")
    first = some.orderBy("doc_id").limit(40)
    long_text = "a long text of words " * 9_000
    more = [
        (10**6, None), (10**6 + 1, ""), (10**6 + 2, " \n"), (10**6 + 3, long_text), (None, "a row without an id"),
        (None, None), (10**6 + 4, "same id, one text of it"), (10**6 + 4, "same id, quite another text"),
        (10**6 + 5, "ask me at someone@example.org today"), (10**6 + 6, "x" * 20_000),
    ]
    odd = spark.createDataFrame([(i, t, "en", "odd", len(t or "")) for i, t in more], first.schema)
    docs = first.unionByName(first.limit(5)).unionByName(odd)
    for name in CLASHING:
        docs = docs.withColumn(name, F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    docs = stage(docs, "odd")
    columns, given = docs.columns, {(r.doc_id, r.text) for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SF_DIR), "odd")
        if name != "packing":
            got = docs.collect()
            assert docs.columns == columns and got
            assert all(r[c] == c + ("none" if r.doc_id is None else str(r.doc_id)) for r in got for c in CLASHING)
            if name != "personal data":
                assert {(r.doc_id, r.text) for r in got} <= given and len({(r.doc_id, r.text) for r in got}) == len(got) or name == "quality"
            else:
                before = got
                assert not any("someone@example.org" in (r.text or "") for r in got)
    check(spark.createDataFrame([(r.doc_id, r.text) for r in before], "doc_id bigint, text string"), docs, packing.SIZE)


def test_pipeline_of_no_documents(spark, tables, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table = tables(name)
        (table.limit(0) if name == "documents" else table).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
