import zlib

import corpus_pipeline
from tradewatch.llm import decontam, langid, queries, secret_scan, simhash

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    found = queries.registry()
    assert sorted(int(k[2:].split("_")[0]) for k in found) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_dedup", "decontamination", "secret_scan", "packing"]


def test_each_stage_does_its_operators_work(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        after = stage(spark, docs, SF)
        if name == "packing":
            pieces = after.collect()
            assert {r.doc_id for r in pieces} == set(before)
            assert all(zlib.crc32(r.ids) is not None and len(r.ids) == 4 * r.length for r in pieces)
            break
        assert after.schema == docs.schema
        rows = {r.doc_id: r for r in after.collect()}
        if name == "language_id":
            assert set(rows) == {r.doc_id for r in langid.identify(docs).where("lang_pred <> 'und'").collect()}
        elif name == "simhash_dedup":
            assert set(rows) == {r.component_id for r in simhash.simhash_components(docs).collect()}
        elif name == "decontamination":
            assert set(rows) == set(before) - {r.doc_id for r in decontam.contamination(docs, bench).collect()}
        else:
            assert set(rows) == set(before)
            assert all(r.text == secret_scan.redact_text(before[i].text) and r.n_chars == len(r.text) for i, r in rows.items())
        docs = spark.createDataFrame(list(rows.values()), docs.schema)


def test_run_gives_the_packed_pieces(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    assert got.count() > 0
