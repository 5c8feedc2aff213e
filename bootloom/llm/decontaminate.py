"""Which documents hold passages of a benchmark, by a positional inverted index.

For a block of benchmark items: count the items' terms over all documents, take each window's rarest term, and
store the positions of the block's terms around those rare ones as postings (term, document, position).
Windows are then looked up in the index alone, the rarest term first: its postings give possible
starts, the second rarest one's offset-adjusted list cuts them down, and the other terms decide.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .textops import ALNUM, LOWER, find_words, hash_spans, slices, text_bytes

WINDOW = 13
BLOCK_BYTES = 8 << 20   # benchmark text of a block, which the driver and every task hold
LENGTH_ROW = -1         # the term of the row that gives a document's number of words
HIT_SHARE = 20          # a document is contaminated if one word in 20 is hit


@dataclass
class Block:
    terms: np.ndarray       # sorted word hashes
    windows: pd.DataFrame   # w, terms (list of places in ``terms``)
    items: pd.DataFrame     # w, item


def word_hashes(array: pa.Array):
    """(hashes, first) of the lower-cased words of an array of texts."""
    data, offs = text_bytes(array)
    data = LOWER[data]
    words = find_words(data, offs, ALNUM)
    return hash_spans(data, words.start, words.length), words


def blocks(benchmark: DataFrame, id_col: str, text_col: str, length: int, most: int):
    """The benchmark in blocks of bounded size, on the driver one at a time."""
    df = common.pick(benchmark, item=common._column(id_col).cast("string"),
                     text=F.coalesce(common._column(text_col).cast("string"), F.lit("")))
    total = df.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item"), F.lit(0)) + 32)).first()[0] or 0
    n = -(-total // most)
    for b in range(n):
        rows = df.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == b).toPandas()
        h, words = word_hashes(pa.array(rows["text"], pa.string()))
        if len(h):
            yield _block([None if pd.isna(i) else i for i in rows["item"]], h, words, length)


def _block(items: list[str | None], h: np.ndarray, words, length: int) -> Block:
    terms, place = np.unique(h, return_inverse=True)
    seen: dict[tuple, int] = {}
    pairs = set()
    for i, item in enumerate(items):
        own = place[words.first[i]:words.first[i + 1]].tolist()
        if not own:
            continue
        for s in range(max(1, len(own) - length + 1)):
            w = seen.setdefault(tuple(own[s:s + length]), len(seen))
            if item is not None:
                pairs.add((w, item))
    return Block(terms, pd.DataFrame({"w": list(seen.values()), "terms": [list(k) for k in seen]}),
                 pd.DataFrame(sorted(pairs), columns=["w", "item"]))


def _places(terms: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Each hash's place in the sorted terms, -1 where it is none of them."""
    at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
    return np.where(terms[at] == h, at, -1)


def term_counts(keyed: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How often each term occurs in all documents."""
    def work(batches):
        total = np.zeros(len(terms), np.int64)
        for batch in slices(batches, "text"):
            h, _ = word_hashes(batch.column("text"))
            at = _places(terms, h)
            total += np.bincount(at[at >= 0], minlength=len(terms))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["term", "n"])

    rows = keyed.select("text").mapInArrow(work, "term long, n long").groupBy("term").agg(
        F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(terms), np.int64)
    out[rows["term"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def order_windows(block: Block, counts: np.ndarray) -> pd.DataFrame:
    """Windows with their (offset, term) pairs, the rarest term first. A window with a term
    that no document has is left out, as it occurs nowhere."""
    rows = []
    for w, terms in zip(block.windows["w"], block.windows["terms"]):
        order = sorted(range(len(terms)), key=lambda i: (counts[terms[i]], terms[i], i))
        if counts[terms[order[0]]]:
            rows.append((w, len(terms), [int(i) for i in order], [int(terms[i]) for i in order]))
    return pd.DataFrame(rows, columns=["w", "size", "offsets", "terms"])


def build_index(keyed: DataFrame, terms: np.ndarray, windows: pd.DataFrame, slop: int = 0) -> DataFrame:
    """Postings ``(term, uid, pos)`` in a written table, and a row (-1, uid, words) per document.

    Positions are kept where they can matter: in a run of the block's terms that holds a
    window's rarest term and is as long as its shortest such window. With ``slop``, all those that are
    less than the size of a window and ``slop`` words away from its rarest term.
    """
    least, most = np.full(len(terms), 1 << 30, np.int64), np.zeros(len(terms), np.int64)
    for first, size in zip(windows["terms"].str[0], windows["size"]):
        least[first] = min(least[first], size)
        most[first] = max(most[first], size)
    schema = pa.schema([("term", pa.int32()), ("uid", pa.int64()), ("pos", pa.int32())])

    def work(batches):
        for batch in slices(batches, "text"):
            h, words = word_hashes(batch.column("text"))
            uid = batch.column("uid").to_numpy()
            term = _places(terms, h)
            at = np.flatnonzero(term >= 0)
            at = _around(at, term[at], words, most, slop) if slop else _runs(at, term[at], words, least)
            doc = words.doc[at]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([np.full(len(uid), LENGTH_ROW), term[at]]).astype(np.int32)),
                pa.array(np.concatenate([uid, uid[doc]])),
                pa.array(np.concatenate([words.counts(), at - words.first[doc]]).astype(np.int32))],
                schema=schema)

    return common.stage(keyed.select("uid", "text").mapInArrow(
        work, "term int, uid long, pos int"), "postings")


def _runs(at: np.ndarray, term: np.ndarray, words, least: np.ndarray) -> np.ndarray:
    """Of the places of terms, those in runs that are as long as a window whose rarest term they hold."""
    fresh = np.ones(len(at), bool)
    fresh[1:] = (np.diff(at) > 1) | (words.doc[at[1:]] != words.doc[at[:-1]])
    run = np.cumsum(fresh) - 1
    n = np.bincount(run) if len(at) else np.zeros(0, np.int64)
    need = np.full(len(n), 1 << 30, np.int64)
    np.minimum.at(need, run, least[term])
    return at[(n >= need)[run]]


def _around(at: np.ndarray, term: np.ndarray, words, most: np.ndarray, slop: int) -> np.ndarray:
    """Of the places of terms, those near a rarest term of the same document."""
    rare, size = at[most[term] > 0], most[term[most[term] > 0]]
    low = np.maximum(rare - (size - 1 + slop), words.first[words.doc[rare]])
    high = np.minimum(rare + size + slop, words.first[words.doc[rare] + 1])
    depth = np.bincount(low, minlength=len(words.doc) + 1) - np.bincount(high, minlength=len(words.doc) + 1)
    return at[np.cumsum(depth)[at] > 0]


def _window_table(spark: SparkSession, windows: pd.DataFrame) -> DataFrame:
    return common.local(spark, windows, "w long, size int, offsets array<int>, terms array<int>")


def _starts(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Possible ``(w, uid, start)`` from the lists of the rarest terms. A block's windows are of
    bounded size, so they go to the postings."""
    rare = windows.withColumn("term", F.element_at("terms", 1)).withColumn(
        "first", F.element_at("offsets", 1))
    return (index.join(F.broadcast(rare), "term").withColumn("start", F.col("pos") - F.col("first"))
            .select("w", "size", "offsets", "terms", "uid", "start"))


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """Exact ``(w, uid, start, size)``: all terms at their places."""
    starts = _starts(index, windows).where("start >= 0")
    second = index.select(F.col("term").alias("t"), F.col("uid").alias("u"), F.col("pos").alias("p"))
    single = starts.where("size = 1").select("w", "uid", "start", "size")
    cut = starts.where("size > 1").join(second, (F.element_at("terms", 2) == F.col("t")) & (F.col("uid") == F.col(
        "u")) & (F.col("start") + F.element_at("offsets", 2) == F.col("p")), "left_semi")
    rest = (cut.selectExpr("w", "uid", "start", "size", "inline(arrays_zip(terms, offsets))")
            .toDF("w", "uid", "start", "size", "t", "o").withColumn("p", F.col("start") + F.col("o")))
    whole = (rest.join(second, (rest["t"] == second["t"]) & (rest["uid"] == second["u"]) & (
        rest["p"] == second["p"]), "left_semi").groupBy("w", "uid", "start", "size").count()
        .where("count = size").drop("count"))
    return whole.unionByName(single)


def proximity_matches(index: DataFrame, windows: DataFrame, slop: int) -> DataFrame:
    """``(w, uid, start)`` where every term of the window is within ``slop`` words of the place
    that the rarest term gives the window, in any order; the index needs the same slop. Where that place
    is before the first word, ``start`` is negative."""
    starts = _starts(index, windows).withColumn("distinct", F.size(F.array_distinct("terms")))
    each = starts.select("w", "uid", "start", "size", "distinct",
                         F.explode(F.array_distinct("terms")).alias("term"))
    near = F.col("pos").between(F.col("start") - slop, F.col("start") + F.col("size") - 1 + slop)
    return (each.join(index, ["term", "uid"]).where(near).groupBy("w", "uid", "start", "distinct")
            .agg(F.count_distinct("term").alias("n")).where("n = distinct").select("w", "uid", "start"))


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(uid, doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` per document.

    NULL and empty texts have no words and are clean. Items without words match nothing; rows with one
    item id are one item. Items with a NULL id cover words as others do (``n_hit``, ``contaminated``); having
    no name, they are not in ``n_items`` and the digest. An empty benchmark leaves all clean. Documents
    with NULL or repeated ids are documents of their own (``common.keyed``).
    """
    return contamination_of(common.keyed(docs, id_col, text_col), benchmark, length, item_col,
                            item_text_col, block_bytes)


def contamination_of(keyed: DataFrame, benchmark: DataFrame, length: int = WINDOW, item_col: str = "item_id",
                     item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``contamination`` of the output of ``common.keyed``."""
    spark = keyed.sparkSession
    lengths, hits, items = None, [], []
    for block in blocks(benchmark, item_col, item_text_col, length, block_bytes):
        windows = order_windows(block, term_counts(keyed, block.terms))
        index = build_index(keyed, block.terms, windows)
        if lengths is None:
            lengths = index.where(F.col("term") == LENGTH_ROW).select("uid", F.col("pos").cast("long").alias("n_words"))
        if not len(windows):
            continue
        found = common.stage(phrase_matches(index.where("term >= 0"), _window_table(spark, windows)), "hits")
        hits.append(found.select("uid", "start", "size"))
        owners = common.local(spark, block.items, "w long, item string")
        items.append(found.select("w", "uid").distinct().join(F.broadcast(owners), "w")
                     .select("uid", "item"))
    if lengths is None:
        index = build_index(keyed, np.zeros(1, np.uint64), order_windows(Block(
            np.zeros(1, np.uint64), pd.DataFrame({"w": [], "terms": []}), None), np.zeros(1)))
        lengths = index.where(F.col("term") == LENGTH_ROW).select("uid", F.col("pos").cast("long").alias("n_words"))
    out = keyed.select("uid", F.col("id").alias("doc_id")).join(lengths, "uid")
    none = F.sha2(F.lit("").cast("binary"), 256)
    if not hits:
        return out.select("uid", "doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"),
                          F.lit(0).cast("long").alias("n_items"), none.alias("items_sha256"),
                          F.lit(False).alias("contaminated"))
    covered = _union(hits).groupBy("uid").agg(F.expr(
        "aggregate(array_sort(collect_set(struct(start, start + size AS stop))), "
        "struct(0 AS upto, 0L AS n), (a, x) -> struct(greatest(a.upto, x.stop) AS upto, "
        "a.n + greatest(0, x.stop - greatest(x.start, a.upto)) AS n)).n").alias("n_hit"))
    named = _union(items).groupBy("uid").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        "uid", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.join(covered, "uid", "left").join(named, "uid", "left").select(
        "uid", "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", none).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * HIT_SHARE >= F.col("n_words"))).alias("contaminated"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(common.table(spark, sf_dir, "documents"),
                         common.table(spark, sf_dir, "benchmark")).drop("uid")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, least(13, len(w)) AS n, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS s
      FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM i),
l AS (SELECT DISTINCT n FROM g),
p AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM d, l WHERE len(w) >= n),
m AS (SELECT doc_id, item_id, s, p.n FROM (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
      FROM p) p JOIN g ON p.g = g.g AND p.n = g.n),
h AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, s + unnest(range(n)) AS x FROM m)
      GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM
      (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
 coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
 coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""
