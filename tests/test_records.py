import json

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bootloom import (Model, append_records, extend_run, fit_bootstrap, read_records,
                      write_records)
from bootloom.operators import summary
from bootloom.plans import fit
from bootloom.sources import commits, records as rec

MODELS = {"a": Model("lasso", ("qty", "lines"), (500.0, 5000.0)), "b": Model("linear", ("qty",))}


@pytest.fixture(scope="module")
def records(orders):
    return fit_bootstrap(orders, "y", MODELS, n_boot=2, training_feats="f").cache()


def key(df):
    return sorted((json.dumps(r.asDict(True), sort_keys=True) for r in df.collect()))


def test_round_trip_is_exact(spark, records, tmp_path):
    path = str(tmp_path / "out")
    write_records(records, path)
    back = read_records(spark, path)
    assert back.schema == rec.RECORD
    assert key(back) == key(records)
    assert key(summary.coef_table(back)) == key(summary.coef_table(records))
    assert key(summary.info_table(back)) == key(summary.info_table(records))


def test_existing_output_is_an_error(records, tmp_path):
    path = str(tmp_path / "out")
    write_records(records, path)
    with pytest.raises(AnalysisException, match="already exists"):
        write_records(records, path)


def test_append_adds_lines(spark, records, tmp_path):
    path = str(tmp_path / "out")
    append_records(records.where("seed = 0"), path)
    append_records(records.where("seed = 1"), path)
    assert key(read_records(spark, path)) == key(records)


def test_extending_a_run_fits_only_what_is_missing(spark, orders, tmp_path):
    path = str(tmp_path / "out")
    assert extend_run(orders, "y", MODELS, path, n_boot=2) == 4
    before = key(read_records(spark, path))
    assert extend_run(orders, "y", MODELS, path, n_boot=2) == 0
    assert key(read_records(spark, path)) == before
    assert extend_run(orders, "y", {"a": MODELS["a"]}, path, n_boot=1, seed_start=7) == 1
    assert extend_run(orders, "y", MODELS, path, n_boot=4) == 4
    back = read_records(spark, path)
    assert back.groupBy("model").agg(F.sort_array(F.collect_list("seed")).alias("s")).orderBy(
        "model").collect() == [("a", [0, 1, 2, 3, 7]), ("b", [0, 1, 2, 3])]
    fresh = fit_bootstrap(orders, "y", MODELS, n_boot=4)
    joined = back.alias("x").join(fresh.alias("y"), ["model", "seed"])
    assert joined.where("abs(x.intercept - y.intercept) > 1e-6 * abs(y.intercept)").count() == 0


def once_each(spark, path):
    rows = [tuple(r) for r in read_records(spark, path).select("model", "seed").collect()]
    assert len(rows) == len(set(rows))
    return sorted(rows)


def test_two_runs_extend_a_folder_at_once(spark, orders, tmp_path, monkeypatch):
    """A second run begins and ends between the first one's look at the folder and its commit."""
    path, append, calls = str(tmp_path / "out"), rec.append_records, []
    extend_run(orders, "y", {"b": MODELS["b"]}, path, n_boot=1)

    def interleaved(records, path, **options):
        calls.append(1)
        if len(calls) == 1:
            assert extend_run(orders, "y", {"b": MODELS["b"]}, path, n_boot=3) == 2
        return append(records, path, **options)

    monkeypatch.setattr(fit, "append_records", interleaved)
    assert extend_run(orders, "y", {"b": MODELS["b"]}, path, n_boot=5) == 2
    assert once_each(spark, path) == [("b", s) for s in range(5)]


def test_a_commit_whose_number_is_taken_is_made_again(spark, records, tmp_path, monkeypatch):
    path, commit, calls = str(tmp_path / "out"), commits.commit, []
    append_records(records.where("seed = 0 AND model = 'a'"), path)

    def late(spark, path, number, files):
        calls.append(number)
        if len(calls) == 1:   # the other run is faster by a moment
            assert append_records(records.where("model = 'b'"), path, once=True) == 2
        return commit(spark, path, number, files)

    monkeypatch.setattr(commits, "commit", late)
    assert append_records(records, path, once=True) == 1
    assert calls == [2, 2, 3]
    assert once_each(spark, path) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    assert key(read_records(spark, path)) == key(records)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["_commits", "model=a", "model=b"]


def test_what_is_not_committed_is_not_read(spark, records, tmp_path):
    path = str(tmp_path / "out")
    write_records(records.where("seed = 0"), path)
    append_records(records.where("seed = 1"), path)
    before = key(read_records(spark, path))
    assert before == key(records)
    name = next((tmp_path / "out" / "model=a").glob("part-*"))
    (name.parent / "part-left-over.json").write_text(name.read_text())
    assert key(read_records(spark, path)) == before


def test_a_number_is_made_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor
    folder = tmp_path / "x"
    folder.mkdir()
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: commits.create_if_absent(spark, f"{folder}/1.json", str(i)), range(24)))
    assert sum(won) == 1 and (folder / "1.json").read_text() == str(won.index(True))
    assert [p.name for p in folder.iterdir() if not p.name.endswith(".crc")] == ["1.json"]


def test_a_number_is_made_once_by_renaming_too(spark, tmp_path):
    target = commits._path(spark, f"file://{tmp_path}/1.json")
    for text, new in (("a", True), ("b", False)):
        (tmp_path / "part").write_text(text)
        part = commits._path(spark, f"file://{tmp_path}/part")
        assert commits._place_if_absent(spark, "other", part, target) is new
    assert (tmp_path / "1.json").read_text() == "a"


def test_a_run_is_not_extended_with_other_settings(spark, orders, tmp_path):
    path = str(tmp_path / "out")
    extend_run(orders, "y", {"a": MODELS["a"]}, path, n_boot=1)
    for models, options in (({"a": Model("lasso", ("qty",), (500.0,))}, {}), ({"a": MODELS["a"]}, {"k": 4})):
        with pytest.raises(ValueError, match="other settings"):
            extend_run(orders, "y", models, path, n_boot=2, **options)


def test_plain_lines_with_older_names(spark, tmp_path):
    """One text file, no model folders, other field names, gaps and NaN, ignored extras."""
    line = {"alpha": 0.1, "random_state": None, "training_data": "d.csv", "training_labels": "t.csv",
            "cv": None, "sklearn_version": "0.18", "mse_min": 2.0, "r2": 0.5, "coef": [1.0, 0.0],
            "intercept": 3.0, "column_names": ["x", "z"], "fit_time": -1.5, "seed": 4}
    text = json.dumps(line) + "\n" + json.dumps({**line, "seed": 5, "r2": float("nan")}) + "\n"
    (tmp_path / "out.txt").write_text(text)
    rows = {r["seed"]: r for r in read_records(spark, str(tmp_path / "out.txt")).collect()}
    assert rows[4]["training_feats"] == "d.csv" and rows[4]["training_targets"] == "t.csv"
    assert rows[4]["engine_version"] == "0.18" and rows[4]["model"]
    assert rows[4]["cv"] is None and np.isnan(rows[5]["r2"])


def test_merge_into_one_file(spark, records, tmp_path):
    write_records(records, str(tmp_path / "out"))
    rec.merge_records(spark, str(tmp_path / "out"), str(tmp_path / "one"))
    files = list((tmp_path / "one").glob("part-*"))
    assert len(files) == 1 and len(files[0].read_text().splitlines()) == 4
    assert key(read_records(spark, str(tmp_path / "one"))) == key(records)


def test_json_text_has_every_field(records):
    for r in rec.as_json(records).collect():
        assert list(json.loads(r["record"])) == rec.RECORD.fieldNames()


def seedless(spark, path):
    """Records as written without seed and model, in two files and a folder of parts."""
    import json
    import os
    x = [[0.0, 0.0, 1.0], [0.0, 0.0, 1.0], [2.0, 1.0, 3.0]]
    os.makedirs(f"{path}/many")
    for name, rows in (("one.txt", x[:2]), ("many/part-00000", x[:1]), ("many/part-00001", x[1:])):
        with open(f"{path}/{name}", "w") as f:
            f.writelines(json.dumps({"coef": r[:2], "intercept": r[2], "column_names": ["a", "b"]}) + "\n"
                         for r in rows)
    return rec.read_records(spark, [f"{path}/one.txt", f"{path}/many"])


def test_seedless_records_are_replicates_of_their_own(spark, tmp_path, monkeypatch):
    from bootloom.operators import score
    records = seedless(spark, tmp_path)
    assert sorted((r["model"], r["n"]) for r in records.groupBy("model").agg(
        F.count_distinct("seed").alias("n")).collect()) == [("many", 3), ("one", 2)]
    df = spark.createDataFrame([(i, float(i), float(i % 3), 5.0 + i, None) for i in range(20)],
                               "row_id long, a double, b double, y double, unused double")
    want = None
    for limit in (64 << 20, 16):
        monkeypatch.setattr(score, "SHIPPED_BYTES", limit)
        for via in ("moments", "rows"):
            got = sorted((r["model"], round(r["rmse"], 9)) for r in score.metric_dist(
                records, df, "y", via=via).collect())
            want = want or got
            assert got == want and len(got) == 5
        assert score.predict(records, df).count() == 100
        assert score.bagged_predict(records, df).count() == 40


def test_repeated_replicates_are_an_error(spark):
    from bootloom.operators import score
    from bootloom.operators.summary import compare_models
    rows = [("m", 1, 0.0, [1.0], ["a"]), ("m", 1, 1.0, [1.0], ["a"])]
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, 2.0, 3.0)], "row_id long, a double, y double")
    for some in (rows, [("m", None, *rows[0][2:])]):
        records = spark.createDataFrame(
            some, "model string, seed long, intercept double, coef array<double>, column_names array<string>")
        for run in (lambda: score.metric_dist(records, df, "y").count(), lambda: score.predict(records, df).count()):
            with pytest.raises(Exception, match="records need a seed each"):
                run()
    metrics = spark.createDataFrame([("a", 1, 0.5), ("a", 1, 0.6), ("b", 1, 0.1)], "model string, seed long, r2 double")
    with pytest.raises(Exception, match="one value for each"):
        compare_models(metrics, "a", "b").collect()
