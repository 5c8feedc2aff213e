"""What workers and written tables hold."""

import glob
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bootloom.functions.scratch import ROW_GROUP
from bootloom.llm import bpe, common, decontaminate, mixing, textops, token_store
from bootloom.llm.token_counts import encode_batch, tokenizer_path


def test_slices_give_freed_memory_back_when_they_begin_and_end(monkeypatch):
    calls = []
    monkeypatch.setattr(textops, "give_back", lambda: calls.append(1))
    batches = [pa.RecordBatch.from_pydict({"text": ["a b", "", None]})] * 3
    assert sum(b.num_rows for b in textops.slices(iter(batches), "text", rows=4)) == 9
    assert len(calls) == 2


def test_row_groups_of_written_tables_are_bounded(spark):
    rows = spark.range(0, 1 << 16, 1, 1).select("id", F.expr(
        "concat_ws('', transform(sequence(1, 8), i -> sha2(cast(id * 8 + i AS string), 512)))").alias("text"))
    written = common.stage(rows, "groups")
    assert written.count() == 1 << 16
    path = written.inputFiles()[0].removeprefix("file://").removeprefix("file:")
    sizes = [pq.ParquetFile(f).metadata for f in glob.glob(path)]
    assert all(m.row_group(g).total_byte_size < 2 * ROW_GROUP for m in sizes for g in range(m.num_row_groups))


def test_encoding_holds_a_bounded_part_of_the_texts():
    encoder = bpe.Encoder(tokenizer_path())
    words = np.random.default_rng(5).integers(0, 1 << 40, (1200, 1100))
    texts = [" ".join(map(np.base_repr, row, [36] * len(row))) for row in words]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    expected = [encoder.whole([t])[0] for t in texts[::200]]
    assert batch.nbytes > 8 << 20
    tracemalloc.start()
    got, n = [], 0
    for part in textops.slices([batch], "text", bpe.SLICE):
        ids, counts = encode_batch(encoder, *textops.text_bytes(part.column("text")))
        ends = np.cumsum(counts)
        got += [ids[b - c:b].tolist() for i, (b, c) in enumerate(zip(ends, counts), n) if i % 200 == 0]
        n += len(counts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == expected and n == len(texts)
    assert peak < 128 << 20


def test_rows_of_the_driver_need_no_python_workers(spark):
    rows = pd.DataFrame({"w": [1, 2, 2], "item": ["a", None, "b"], "terms": [[1, 2], [], [3]]})
    table = common.local(spark, rows, "w int, item string, terms array<int>")
    assert [tuple(r) for r in table.collect()] == [(1, "a", [1, 2]), (2, None, []), (2, "b", [3])]
    assert table.schema.simpleString() == "struct<w:int,item:string,terms:array<int>>"
    assert common.local(spark, rows[:0], "w int, item string, terms array<int>").collect() == []
    assert "LocalTableScan" in table._jdf.queryExecution().executedPlan().toString()


def test_the_pipelines_stages_start_python_workers_of_one_kind(spark, monkeypatch):
    made = []
    monkeypatch.setattr(type(spark.sparkContext), "parallelize", lambda *a, **b: made.append(a) or pytest.fail("a list"))
    docs = spark.sql("SELECT id AS doc_id, concat('a b c d e f g h i j k l m n ', id) AS text, 'x' AS source FROM range(20)")
    items = spark.sql("SELECT '1' AS item_id, 'a b c d e f g h i j k l m n' AS text")
    assert decontaminate.contamination(docs, items).where("contaminated").count() == 20
    assert mixing.mix(docs).count() == 20
    assert token_store.stored_digests(docs, tokenizer_path()).count() == 20
    assert not made
