"""The pipeline's stages against plain versions of them."""

import os
import zlib

import numpy as np
import pytest

import corpus_pipeline as cp
from bootloom.llm import bpe, common, mixing, substring_dedup, toxicity
from bootloom.llm.token_counts import tokenizer_path

from . import brute


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The documents before and after each stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(common.stage(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_names_and_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "ngram_join", "decontaminate", "mixing", "token_store"]
    assert all(s.columns == steps[0].columns for s in steps[:-1])


def test_toxicity(spark, sf_dir, steps):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(steps[0], labels, rows=~toxicity.held_out())
    kept = {r["doc_id"] for r in toxicity.score(steps[0], model).where("predicted = 0").collect()}
    assert rows(steps[1]) == [r for r in rows(steps[0]) if r[0] in kept]


def test_near_duplicates(steps):
    before = rows(steps[1])
    roots = brute.near_components([r[1] for r in before], 5, 80)
    assert rows(steps[2]) == [r for i, r in enumerate(before) if roots[i][1] == i]


def test_contamination(spark, sf_dir, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    before = rows(steps[2])
    found = brute.contamination([r[1] for r in before], items)
    assert rows(steps[3]) == [r for r, f in zip(before, found) if not f[4]]


def test_mixing(steps):
    times = {r["doc_id"]: r["epochs"] for r in mixing.mix(steps[3]).collect()}
    assert rows(steps[4]) == sorted(r for r in rows(steps[3]) for _ in range(times[r[0]]))


def test_tokens(steps):
    texts = [(r["doc_id"], r["text"]) for r in steps[4].collect()]
    ids = bpe.load(tokenizer_path()).whole([t for _, t in texts])
    expected = sorted((i, len(x) + 1, zlib.crc32(np.array(x + [0], "<u4").tobytes())) for (i, _), x in zip(texts, ids))
    got = steps[5].collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == expected
    order = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted(r["doc_id"] for r in got)


def test_whole_run(spark, sf_dir, steps):
    assert rows(cp.run(spark, sf_dir)) == rows(steps[5])


def test_stages_take_odd_documents(spark, sf_dir, messy):
    docs = messy
    for name, stage in cp.STAGES:
        out = common.stage(stage(spark, docs, sf_dir), f"odd-{name}")
        if name != "token_store":
            assert out.columns == messy.columns
        assert 0 < out.count() <= 2 * docs.count()
        docs = out


def test_stages_leave_results_and_settings_of_others_alone(spark, sf_dir, steps):
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch",
            "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(k) for k in keys]
    held = substring_dedup.op8_substring_dedup(spark, sf_dir)
    kept = [stage(spark, steps[i], sf_dir) for i, (_, stage) in enumerate(cp.STAGES)]
    assert held.count() == steps[0].count()
    assert [k.count() for k in kept] == [s.count() for s in steps[1:]]
    assert [spark.conf.get(k) for k in keys] == before


def test_passing_removes_only_its_own(spark):
    outer = common.stage(spark.range(3), "outer")
    with common.passing(spark):
        inner = common.stage(spark.range(4), "inner")
        kept = common.settled(spark, "kept", lambda: common.stage(spark.range(5), "behind"))
        files = inner.inputFiles() + kept.inputFiles()
        assert kept.count() == 5 and len(files) > 1
    assert outer.count() == 3
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
