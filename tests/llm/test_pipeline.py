"""The pipeline's stages against brute force, stage by stage."""

from test_packing import check
from test_pii import brute as pii_brute
from test_simhash import brute_components, brute_fp

import corpus_pipeline as P
from alertlens.llm import mixing, pii, toxicity
from alertlens.llm.common import materialize

NAMES = ["toxicity", "simhash", "pii", "mixing", "packing"]


def test_stages(spark, sf_small):
    assert [n for n, _ in P.STAGES] == NAMES
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    after = []
    for name, stage in P.STAGES:
        out = materialize(stage(spark, docs, sf_small), f"test-{name}")
        if name != NAMES[-1]:
            assert out.dtypes == docs.dtypes
        after.append(out.collect())
        if name == "toxicity":
            model = toxicity.fit(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
            want = {d for d, t in given.items() if toxicity.probability(toxicity.evidence(t, model)[0], model) < 0.3}
            assert {r.doc_id for r in after[-1]} == want and len(want) < len(given)
        docs = out
    kept = {r.doc_id: r.text for r in after[0]}
    comp = brute_components([(d, brute_fp(t)) for d, t in kept.items()])
    assert sorted(r.doc_id for r in after[1]) == sorted(set(comp.values())) and len(after[1]) < len(after[0])
    hidden = 0
    for r in after[2]:
        spans = pii_brute(kept[r.doc_id])
        hidden += len(spans)
        assert pii_brute(r.text) == [] and r.text.count("[EMAIL]") >= sum(s[1] == 0 for s in spans)
    assert hidden
    copies = {}
    for r in after[3]:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    mid = spark.createDataFrame(after[2])
    assert copies == {r.doc_id: r.copies for r in mixing.op3(spark, mid).collect()}
    check([(r.doc_id, r.text) for r in after[3]], after[4])
    assert pii.KINDS[0] == "email"


def test_run_and_odd_rows(spark, sf_small):
    assert P.run(spark, sf_small).count() > 0
    rows = [(1, None, None, None, None), (2, "", "en", "src1", 0), (2, "", "en", "src1", 0), (None, "a b c d", "en", "src0", 7), (3, "word " * 20_000, "en", "src0", 1)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, h string")
    for frame in (docs, docs.limit(0)):
        for name, stage in P.STAGES:
            out = materialize(stage(spark, frame, sf_small), f"odd-{name}")
            if name != NAMES[-1]:
                assert out.columns == frame.columns
            frame = out
