import corpus_pipeline as cp
import __spark_entry__ as entry
from pitchside.llm.common import read_table
from tests.conftest import SF0001


def test_queries_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert [n for n, _ in cp.STAGES] == ["quality", "near_duplicates", "passages", "decontamination", "token_ids"]


def test_every_stage_takes_effect(spark):
    docs = read_table(spark, SF0001, "documents")
    columns, ids, size = docs.columns, {r.doc_id for r in docs.collect()}, None
    for name, stage in cp.STAGES:
        out = cp.materialize(stage(spark, docs, SF0001), "test_" + name)
        kept = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept <= ids and len(kept) == out.count()
        if name != "token_ids":
            assert out.columns == columns
            if name in ("quality", "near_duplicates", "decontamination"):
                assert kept < ids
            else:
                before = docs.selectExpr("sum(octet_length(text))").first()[0]
                assert kept == ids and out.selectExpr("sum(octet_length(text))").first()[0] < before
        docs, ids = out, kept
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        read_table(spark, SF0001, t).limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert cp.run(spark, str(tmp_path)).collect() == []
