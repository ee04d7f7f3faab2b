import corpus_pipeline as cp
from aerocast.llm import common as c
from conftest import SF


def test_stages_run_in_order_and_take_effect(spark):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line dedup", "n-gram Jaccard join", "PII", "packing"]
    docs = c.read(spark, SF, "documents")
    cols, kept = docs.columns, docs
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in cp.STAGES[:-1]:
        kept = c.stored(stage(spark, kept, SF), "test-stage")
        assert kept.columns == cols, name
        assert 0.5 * len(before) < kept.count() <= len(before), name
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert set(texts) < set(before) and any(texts[i] != before[i] for i in texts)
    pieces = cp.pack(spark, kept, SF).toPandas()
    assert set(pieces["doc_id"]) == set(texts)
    assert (pieces.groupby("doc_id")["length"].sum() == pieces.groupby("doc_id")["doc_tokens"].first()).all()


def test_queries_are_registered():
    import __spark_entry__ as e
    names = e.queries()
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names
