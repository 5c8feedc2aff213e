"""Every registered query against its SQL twin, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as e
from tools.compare import differences

ORACLES = e.own_oracles()


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def test_every_twin_has_a_query():
    assert set(ORACLES) == set(e.own_queries())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_its_twin(spark, sf_dir, db, key):
    assert differences(e.queries()[key](spark, sf_dir).toPandas(), db.execute(ORACLES[key]).df()) == ""


def test_flagship(spark):
    row = e.entry(spark).first()
    assert row["model"] == "full" and 0.6 < row["r2_mean"] < 0.9
    assert row["r2_lower"] <= row["r2_mean"] <= row["r2_upper"]


def test_selection_is_not_trivial(spark, sf_dir):
    freq = {r["feature"]: r["p_nonzero"] for r in e.selection_freq(spark, sf_dir).collect()}
    assert freq["partkey"] == 1.0 and freq["size"] < 1.0


def test_rows_without_index_are_numbered_across_files(spark, sf_dir, monkeypatch):
    read, files = e.frames.read_table, []

    def spy(spark, path, **options):
        files.append(spark.read.option("header", True).csv(path).select("_metadata.file_path").distinct().count())
        return read(spark, path, **options)

    monkeypatch.setattr(e.frames, "read_table", spy)
    rows = e.load_no_index(spark, sf_dir).collect()
    assert len(files) == 2 and min(files) > 1
    for name in "ab":
        was = [r["was"] for r in sorted((r for r in rows if r["file"] == name), key=lambda r: r["row_id"])]
        assert was == sorted(was) and len(was) > 100
        assert sorted(r["row_id"] for r in rows if r["file"] == name) == list(range(len(was)))
