import pytest
from pyspark.sql import functions as F

from bootloom.sources import frames


def write(path, text):
    path.write_text(text)
    return str(path)


def test_blank_header_becomes_row_id(spark, tmp_path):
    df = frames.read_table(spark, write(tmp_path / "a.csv", ",a,b\n5,1,2.5\n3,4,5\n"))
    assert df.columns == ["row_id", "a", "b"]
    assert sorted(r["row_id"] for r in df.collect()) == [3, 5]


@pytest.mark.parametrize("name", ["Unnamed: 0", "index"])
def test_named_index_becomes_row_id(spark, tmp_path, name):
    df = frames.read_table(spark, write(tmp_path / "a.csv", f"{name},a\n7,1\n"))
    assert [tuple(r) for r in df.collect()] == [(7, 1)]


def test_rows_without_index_are_numbered_in_file_order(spark, tmp_path):
    text = "a\n" + "\n".join(str(i * 10) for i in range(5000)) + "\n"
    path = write(tmp_path / "a.csv", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = frames.read_table(spark, path)
        assert df.rdd.getNumPartitions() > 1
        assert df.where("row_id * 10 <> a").count() == 0
        assert df.agg(F.count_distinct("row_id"), F.max("row_id")).first() == (5000, 4999)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_files_are_numbered_by_name_whatever_their_size(spark, tmp_path):
    for name, values in (("a", range(3)), ("b", range(3, 900)), ("c", range(900, 950))):
        (tmp_path / "t.csv").mkdir(exist_ok=True)
        write(tmp_path / "t.csv" / f"{name}.csv", "v\n" + "\n".join(map(str, values)) + "\n")
    df = frames.read_table(spark, str(tmp_path / "t.csv"))
    assert df.where("row_id <> v").count() == 0 and df.count() == 950


def test_parquet_is_read_too(spark, tmp_path):
    spark.range(3).select(F.col("id").alias("index"), F.lit(1.0).alias("a")).write.parquet(
        str(tmp_path / "a.parquet"))
    assert frames.read_table(spark, str(tmp_path / "a.parquet")).columns == ["row_id", "a"]
    spark.range(3).select(F.lit(1.0).alias("a")).write.parquet(str(tmp_path / "b"))
    df = frames.read_table(spark, str(tmp_path / "b"), format="parquet")
    assert sorted(r["row_id"] for r in df.collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match="format"):
        frames.read_table(spark, "x", format="xls")


def test_align_joins_one_to_one(spark):
    feats = spark.createDataFrame([(0, 1.0), (1, 2.0)], "row_id long, a double")
    target = spark.createDataFrame([(1, 20.0), (0, 10.0)], "row_id long, y double")
    assert sorted(map(tuple, frames.align(feats, target).collect())) == [
        (0, 1.0, 10.0), (1, 2.0, 20.0)]


@pytest.mark.parametrize("ids", [[0], [0, 1, 2], [0, 0], [0, 1, 1]])
def test_align_rejects_missing_and_repeated_ids(spark, ids):
    feats = spark.createDataFrame([(0, 1.0), (1, 2.0)], "row_id long, a double")
    target = spark.createDataFrame([(i, 1.0) for i in ids], "row_id long, y double")
    for columns in (["row_id", "a", "y"], ["a"]):  # also where only some columns are read
        with pytest.raises(Exception, match="one to one"):
            frames.align(feats, target).select(*columns).collect()


def test_align_shuffles_each_side_once(spark, monkeypatch):
    sides = [spark.range(50).selectExpr("id AS row_id", f"id * 1.0D AS {c}") for c in "ay"]
    plan = frames.align(*sides)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_split(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(4)], "row_id long, test_set int")
    ids = {flag: sorted(r[0] for r in frames.split_rows(df, flag).collect())
           for flag in ("train", "test", "all")}
    assert ids == {"train": [0, 2], "test": [1, 3], "all": [0, 1, 2, 3]}
    assert frames.split_rows(df, "train").columns == ["row_id"]


def test_split_without_marker_keeps_all_rows(spark):
    assert frames.split_rows(spark.range(4), "train").count() == 4


@pytest.mark.parametrize("columns", [1, 60])
@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_missing_values_are_rejected(spark, bad, columns):
    names = [f"c{i}" for i in range(columns)]
    df = spark.createDataFrame([(0, 1.0), (1, bad)], "row_id long, a double").select(
        "row_id", *[F.col("a").alias(c) for c in names])
    with pytest.raises(ValueError, match="1 rows have a missing"):
        frames.frame_stats(df, names)


def test_missing_ids_are_rejected(spark):
    df = spark.createDataFrame([(None, 1.0), (1, 2.0)], "row_id long, a double")
    with pytest.raises(ValueError, match="1 have no row_id"):
        frames.frame_stats(df, ["a"])


def test_wide_statistics_equal_narrow_ones(spark, monkeypatch):
    df = spark.range(10, 500).select(F.col("id").alias("row_id"), F.sqrt("id").alias("a"),
                                     (F.col("id") % 7).alias("b"))
    narrow = frames.frame_stats(df, ["a", "b"])
    monkeypatch.setattr(frames, "CODEGEN_COLUMNS", 1)
    wide = frames.frame_stats(df, ["a", "b"])
    assert (wide.n, wide.min_id, wide.max_id) == (490, 10, 499) == (narrow.n, narrow.min_id, narrow.max_id)
    assert all(abs(wide.means[c] - narrow.means[c]) < 1e-9 for c in "ab")


def test_empty_table_is_rejected(spark):
    with pytest.raises(ValueError, match="no rows"):
        frames.frame_stats(spark.createDataFrame([], "row_id long, a double"), ["a"])


def test_rows_keep_their_numbers_when_splits_change(spark, tmp_path):
    """Files are cut anew between reading and use; no row is lost or numbered otherwise."""
    for k in range(3):
        with open(tmp_path / f"part{k}.csv", "w") as f:
            f.write("x\n" + "".join(f"{k * 20000 + i}\n" for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        df = frames.read_table(spark, str(tmp_path), schema="x long")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
        assert df.where("row_id = x").count() == 60000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parquet_rows_are_numbered_without_a_copy(spark, tmp_path, monkeypatch):
    path, size = str(tmp_path / "t.parquet"), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.range(0, 5000, 1, 4).selectExpr("id AS was", "CAST(id AS string) AS text").write.option(
        "parquet.block.size", 4096).parquet(path)
    monkeypatch.setattr(frames, "scratch_path", None)
    numbers = []
    try:
        for most in (size, "2k", "64k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            rows = sorted((r["row_id"], r["was"]) for r in frames.read_table(spark, path).collect())
            assert [r for r, _ in rows] == list(range(5000))
            numbers.append(rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert numbers[0] == numbers[1] == numbers[2] and [w for _, w in numbers[0]] == list(range(5000))
