"""The pipeline's stages on a small table against plain versions."""

import corpus_pipeline
from pricegrid.llm.common import table
from pricegrid.session import stage
from tests.conftest import SF
from tests.llm import brute


def test_stages(spark):
    docs = table(spark, SF, "documents")
    kept = [docs]
    for name, apply in corpus_pipeline.STAGES:
        kept.append(stage(apply(spark, kept[-1], SF), "test-pipeline"))
    for out in kept[:-1]:
        assert out.columns == docs.columns
    ids = [{r["doc_id"] for r in out.select("doc_id").collect()} for out in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[4] == ids[5]
    pairs = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    lines = brute.line_dedup(pairs(kept[1]))
    assert {r["doc_id"]: r["text"] for r in kept[2].collect()} == {d: t for d, t in lines.items() if t.strip()}
    assert ids[3] == {low for _, _, low in brute.simhash_rows(pairs(kept[2]))}
    assert kept[5].where("n_tokens <= 0").count() == 0
    assert corpus_pipeline.run(spark, SF).count() == len(ids[5])
