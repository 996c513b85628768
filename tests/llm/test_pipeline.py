"""The pipeline's stages, each on its own input, against plain versions."""

import numpy as np
import public_tokenizers
from conftest import DATA
from tokenizers import Tokenizer

from llm_cases import none  # noqa: F401  fixtures

import corpus_pipeline
from bazaarmill.llm import curriculum, decontaminate, langid, simhash, tokenids
from bazaarmill.llm.common import read


def test_stages_follow_each_other(spark):
    docs = read(spark, DATA, "documents")
    columns = docs.columns
    seen = [docs.count()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "curriculum_mix", "token_ids"]

    kept = corpus_pipeline.stored(stages["language_id"](spark, docs, DATA))
    p = langid.predictor(spark, langid.learn(langid.training(docs)))
    fine = {r["doc_id"] for r in docs.select("doc_id", p.alias("p")).collect() if r["p"]["lang_pred"] != "und" and not r["p"]["ambiguous"]}
    assert {r["doc_id"] for r in kept.collect()} == fine and kept.columns == columns

    once = corpus_pipeline.stored(stages["simhash_near_dedup"](spark, kept, DATA))
    of = simhash.clusters(simhash.stored(simhash.fingerprints(kept))).collect()
    assert sorted(r["doc_id"] for r in once.collect()) == sorted({r["component_id"] for r in of}) and once.columns == columns

    clean = corpus_pipeline.stored(stages["benchmark_decontamination"](spark, once, DATA))
    bad = {r["doc_id"] for r in decontaminate.scan(once, read(spark, DATA, "benchmark")).where("n_hit > 0").collect()}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in once.collect()} - bad and clean.columns == columns

    mixed = corpus_pipeline.stored(stages["curriculum_mix"](spark, clean, DATA))
    assert mixed.columns == columns
    size = clean.select("source", curriculum.size_of().alias("n")).groupBy("source").sum("n").collect()
    taken = {r[0]: r[1] for r in mixed.select("source", curriculum.size_of().alias("n")).groupBy("source").sum("n").collect()}
    assert all(taken.get(r[0], 0) <= 2 * r[1] for r in size)
    assert abs(sum(taken.values()) / sum(r[1] for r in size) - 1.5) < 0.1
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2

    ids = stages["token_ids"](spark, mixed, DATA).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((r["doc_id"], tok.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in mixed.collect())
    assert sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in ids) == want
    assert seen[0] > len(fine) or len(fine) == seen[0]


def test_run(spark):
    got = corpus_pipeline.run(spark, DATA).collect()
    ends = sorted((r["start"], r["start"] + r["n_tokens"]) for r in got)
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))


def test_stages_take_empty_tables(spark, none):
    docs = none.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        assert out.count() == 0


def test_ids_are_written_in_training_order(spark):
    """The mix is a table sorted by training position; the token file keeps that order."""
    docs = read(spark, DATA, "documents")
    mixed = corpus_pipeline.stored(curriculum.curriculum_stage(spark, docs, DATA))
    rows, name = tokenids.with_place(mixed)
    assert name == "_place"
    want = [r["doc_id"] for r in rows.orderBy(name).collect()]
    assert want != sorted(want)
    # the place has the order of the training positions
    cols = [f"`{c}`" for c in docs.columns]
    assert want == [r["doc_id"] for r in curriculum.curriculum_stage(spark, docs, DATA).select(*cols).collect()]
    ids = tokenids.token_stage(spark, mixed, DATA).collect()
    assert [r["doc_id"] for r in sorted(ids, key=lambda r: r["start"])] == want


def test_place_without_files(spark, none):
    docs = none.select("doc_id", "text")
    assert tokenids.with_place(docs) == (docs, "doc_id")
