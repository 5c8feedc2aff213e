"""A training-data pipeline out of the corpus operators: documents in, token shards out.

A stage takes NULL, empty and repeated texts, NULL and repeated ids (rows of their own) and empty tables as its
operator does, and hands on the columns it got, whatever their names. It decides first: the decisions (ids) are
written, and the scratch tables behind them are removed; those of others are not touched. Its result is written
before the next stage begins.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from bootloom.functions.ship import ship_package
from bootloom.llm import common, decontaminate, mixing, ngram_join, token_store, toxicity
from bootloom.llm.token_counts import tokenizer_path

NEAR_WORDS, NEAR_PERCENT = 5, 80


def _without(keyed, dropped):
    """The rows of ``keyed`` but for those named in ``dropped(uid)``, as they came."""
    return keyed.join(dropped, "uid", "left_anti").select("row.*")


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity model rejects go. NULL and empty texts are scored like any other; without labels
    of both kinds all or none are toxic, as the share of toxic labels says."""
    ship_package(spark)
    keyed = common.keyed(docs, whole=True)

    def rejected():
        model = toxicity.fit(docs, common.table(spark, sf_dir, "labels"), rows=~toxicity.held_out())
        return toxicity.score(keyed, model, "uid").where("predicted = 1").select(F.col("doc_id").alias("uid"))

    return _without(keyed, common.settled(spark, "toxic", rejected))


def drop_near_duplicates(spark, docs, sf_dir):
    """Of each group of near duplicates (5 words, similarity 0.8), the document of the smallest id stays; of rows of
    one id, the first by text hash. Texts without words stay."""
    ship_package(spark)
    keyed = common.keyed(docs, whole=True)
    later = common.settled(spark, "later", lambda: ngram_join.classes_of(keyed, NEAR_WORDS, NEAR_PERCENT).where(
        "uid <> first_uid").select("uid"))
    return _without(keyed, later)


def drop_contaminated(spark, docs, sf_dir):
    """Documents that the benchmark contaminates go; those without words stay."""
    ship_package(spark)
    keyed = common.keyed(docs, whole=True)
    found = common.settled(spark, "contaminated", lambda: decontaminate.contamination_of(
        keyed, common.table(spark, sf_dir, "benchmark")).where("contaminated").select("uid"))
    return _without(keyed, found)


def mix_sources(spark, docs, sf_dir):
    """Each document as often as the mix holds it; a NULL source is one of its own. Texts without words
    come with each whole epoch, and once more where their place is before the cut."""
    ship_package(spark)
    keyed = common.keyed(docs, whole=True)
    rows = keyed.select("uid", "text", F.col("row.source").alias("source"))
    times = common.settled(spark, "times", lambda: mixing.mix(rows, id_col="uid").where("epochs > 0").select(
        F.col("doc_id").alias("uid"), "epochs"))
    return (keyed.join(times, "uid").select("row", F.explode(F.sequence(F.lit(1), F.col("epochs"))))
            .select("row.*"))


def write_tokens(spark, docs, sf_dir):
    """Token shards with their index; one row per record, read back from them."""
    ship_package(spark)
    return token_store.stored_digests(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mixing", mix_sources),
    ("token_store", write_tokens),
]


def run(spark, sf_dir):
    """All stages over the documents; the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Tokenizers are not SQL; tests/llm compares near duplicates, decontamination and tokens with plain versions.
ORACLE_SQL = None
