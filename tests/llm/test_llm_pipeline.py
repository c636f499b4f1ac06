"""The pipeline stage by stage against brute force, and on odd documents."""

import corpus_pipeline as P
import pytest
from alertflow.llm import mixing, quality
from alertflow.llm.common import written
from pyspark.sql import functions as F

from tests.llm.test_llm_small import SF, check_mix, check_packing, plain_components, plain_exact, plain_fingerprint


def rows(df):
    return sorted((r.doc_id, r.text or "") for r in df.collect())


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in P.STAGES:
        docs = out[name] = written(stage(spark, docs, SF), f"test-{name}")
    return out


def test_stage_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "mix_sources", "best_fit_packing"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_quality_stage_keeps_what_the_classifier_accepts(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.judge(stages["documents"], labels, F.col("source"), F.concat_ws("/", "source", "lang"))
    want = sorted((r.doc_id, r.text or "") for r in judged.where(F.col("_posterior") >= quality.KEEP_FROM).collect())
    assert rows(stages["quality_classifier"]) == want
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    kept = {d for d, _ in want}
    assert len(good - kept) <= 0.02 * len(good)


def test_dedup_stages_against_brute_force(stages):
    before = rows(stages["quality_classifier"])
    want = sorted((d, t) for (d, t), (_, keep, *_rest) in zip(before, plain_exact(before, min)) if d == keep)
    assert rows(stages["exact_dedup"]) == want
    groups = plain_components([(d, plain_fingerprint(t)) for d, t in want])
    assert rows(stages["simhash_near_dedup"]) == sorted((d, t) for (d, t), (_, _, c) in zip(want, groups) if d == c)


def test_mix_stage_takes_documents_as_often_as_the_mix_says(stages):
    kept = stages["simhash_near_dedup"]
    chosen = mixing.mix(kept, P.SOURCE_WEIGHTS).collect()
    check_mix(chosen, {r.doc_id: r.source for r in kept.collect()}, P.SOURCE_WEIGHTS)
    text = dict(rows(kept))
    want = sorted((r.doc_id, text[r.doc_id]) for r in chosen for _ in range(r.taken // r.size if r.size else 0))
    assert rows(stages["mix_sources"]) == want


def test_pack_stage_holds_every_token_once(stages):
    used, least = check_packing(stages["best_fit_packing"].collect(), rows(stages["mix_sources"]), 2048)
    assert used <= least + 1


def test_pipeline_on_odd_and_empty_documents(spark):
    odd = [(0, None, None, None, None), (1, "", "en", "s", 0), (2, "x", "en", "s", 1), (2, "x", "en", "s", 1), (None, "y z", "en", None, 3),
           (None, "other words here", "en", "t", 5), (3, "long words " * 20_000, "en", "t", 1)]
    docs = spark.createDataFrame(odd, spark.read.parquet(f"{SF}/documents.parquet").schema)
    for start in (docs, docs.where("false")):
        df = start
        for name, stage in P.STAGES:
            df = written(stage(spark, df, SF), f"odd-{name}")
        assert (df.count() > 0) == (start is docs)
