"""Near-duplicate documents by the Jaccard similarity of their word n-gram sets.

Documents with equal sets are one class, and only its first document joins. N-grams are ordered
rare first, by the count of their rarest word over all documents; two sets that are similar enough
share one of their first ones. Pairs that share such a prefix n-gram pass the length, positional
and suffix filters, and what is left is verified once on the full sets.

Groups of thousands of near copies are not paired with one another: in a first round each document
meets the most typical document of each of its prefix n-grams, and the second round pairs only
documents that are not yet in one component. No link between components is lost, and a link within
one changes nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .components import components
from .textops import LOWER, U, find_words, hash_spans, mix, ngram_starts, ngrams, signed, slices, text_bytes

SKETCH_BITS = 18     # word counts are kept for 2^18 hash buckets: of fixed size, so it can be sent to all
SIGN = 8             # longs of the parity signature
AT_ONCE = {"most": 1 << 20, "rows": 2048}    # bytes of text and rows whose sets are made at once
MARKS = 1 << 26      # bits that mark documents wanted again; up to an eighth as many are marked, else joined


def _sets(batch, size: int):
    """Distinct n-gram hashes by row, the word hashes, and each n-gram's first word."""
    data, offs = text_bytes(batch.column("text"))
    data = LOWER[data]
    words = find_words(data, offs)
    h = hash_spans(data, words.start, words.length)
    at = ngram_starts(words, size)
    grams, doc = ngrams(h, size)[at], words.doc[at]
    n = words.counts()
    for short in range(1, size):  # the whole sequence is the one n-gram
        rows = np.flatnonzero(n == short)
        if len(rows):
            first = words.first[rows]
            grams = np.append(grams, mix(ngrams(h, short)[first] + U(short)))
            doc, at = np.append(doc, rows), np.append(at, first)
    return grams, doc, at, h


def word_counts(keyed: DataFrame) -> np.ndarray:
    """Occurrences of words over all documents, by hash bucket."""
    def work(batches):
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in slices(batches, "text", **AT_ONCE):
            data, offs = text_bytes(batch.column("text"))
            data = LOWER[data]
            words = find_words(data, offs)
            h = hash_spans(data, words.start, words.length)
            total += np.bincount((h >> U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])],
                                         names=["bucket", "n"])

    rows = keyed.select("text").mapInArrow(work, "bucket int, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << SKETCH_BITS, np.int64)
    out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out


def prefix_length(n, percent: int):
    """N-grams of which one must be shared with any set that is similar enough."""
    return n - (percent * n + 99) // 100 + 1


def document_sets(keyed: DataFrame, size: int, percent: int) -> DataFrame:
    """``(uid, n, s1, s2, prefix, sign)``: set size, two hashes of the set, the rare-first prefix
    and a signature with a bit for the parity of each of 64 * SIGN hash classes. Written."""
    counts = keyed.sparkSession.sparkContext.broadcast(word_counts(keyed))
    schema = pa.schema([("uid", pa.int64()), ("n", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()),
                        ("prefix", pa.list_(pa.int64())), ("sign", pa.list_(pa.int64()))])

    def work(batches):
        for batch in slices(batches, "text", **AT_ONCE):
            rows = batch.num_rows
            grams, doc, at, h = _sets(batch, size)
            count = counts.value[(h >> U(64 - SKETCH_BITS)).astype(np.int64)]
            rare = count[at]
            for i in range(1, size):
                step = np.minimum(at + i, len(h) - 1)
                rare = np.minimum(rare, count[step]) if len(h) else rare
            order = np.lexsort([grams, rare, doc])
            # equal n-grams have equal counts, so repeats are neighbours
            g, d = grams[order], doc[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
            g, d = g[new], d[new]
            n = np.bincount(d, minlength=rows)
            first = np.cumsum(n) - n
            bounds = np.append(first, len(g))
            sums = [np.append(0, np.cumsum(x))[bounds].astype(np.uint64) for x in (mix(g), mix(g ^ U(0x5BD1E995)))]
            parity = np.bincount(d * (64 * SIGN) + (g & U(64 * SIGN - 1)).astype(np.int64),
                                 minlength=rows * 64 * SIGN) & 1
            sign = np.packbits(parity.astype(bool), bitorder="little").view("<i8")
            take = np.where(n > 0, prefix_length(n, percent), 0)
            ends = np.cumsum(take)
            pick = np.repeat(first - ends + take, take) + np.arange(ends[-1] if rows else 0)
            yield pa.RecordBatch.from_arrays([
                batch.column("uid"), pa.array(n.astype(np.int32)), pa.array(signed(np.diff(sums[0]))),
                pa.array(signed(np.diff(sums[1]))),
                pa.ListArray.from_arrays(np.append(0, ends).astype(np.int32), signed(g[pick])),
                pa.ListArray.from_arrays(np.arange(0, rows * SIGN + 1, SIGN, dtype=np.int32), sign)],
                schema=schema)

    return common.stage(keyed.select("uid", "text").mapInArrow(
        work, "uid long, n int, s1 long, s2 long, prefix array<long>, sign array<long>"), "sets")


def _full_sets(keyed: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``(uid, grams)`` of the documents in ``wanted(uid)``."""
    schema = pa.schema([("uid", pa.int64()), ("grams", pa.list_(pa.int64()))])

    def work(batches):
        for batch in slices(batches, "text", **AT_ONCE):
            grams, doc, _, _ = _sets(batch, size)
            order = np.lexsort([grams, doc])
            g, d = grams[order], doc[order]
            new = np.ones(len(g), bool)
            new[1:] = (g[1:] != g[:-1]) | (d[1:] != d[:-1])
            n = np.bincount(d[new], minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.ListArray.from_arrays(
                np.append(0, np.cumsum(n)).astype(np.int32), signed(g[new]))], schema=schema)

    columns = "uid long, grams array<long>"
    wanted = common.stage(wanted, "wanted")
    if wanted.count() > MARKS // 8:
        return keyed.select("uid", "text").join(wanted, "uid", "left_semi").mapInArrow(work, columns)
    place = F.pmod(F.xxhash64("uid"), F.lit(MARKS))
    words = wanted.select(place.alias("b")).groupBy(F.shiftright("b", 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(b & 63 AS INT)))").alias("bits")).toPandas()
    marks = np.zeros(MARKS // 64, np.int64)
    marks[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    marks = keyed.sparkSession.sparkContext.broadcast(marks)

    def marked(batches):
        for batch in batches:
            b = batch.column("place").to_numpy()
            yield batch.filter(pa.array((marks.value[b >> 6] >> (b & 63)) & 1 == 1))

    # a few others share a mark; they join with no pair
    return keyed.select("uid", "text", place.alias("place")).mapInArrow(
        lambda batches: work(marked(batches)), columns)


def _similar(percent: int):
    """Filters on a pair with sizes n, m, positions p, q of a shared n-gram and signatures."""
    n, m = F.col("n").cast("long"), F.col("m").cast("long")
    # least overlap of a linked pair: percent / (100 + percent) of both sizes, rounded up
    least = F.floor((percent * (n + m) + 99 + percent) / F.lit(100 + percent))
    length = (100 * n >= percent * m) & (100 * m >= percent * n)
    place = F.least(n - F.col("p"), m - F.col("q")) >= least
    apart = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(SIGN)), F.lit(0))
    return length, place, apart <= n + m - 2 * least


def _verified(pairs: DataFrame, keyed: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the distinct pairs ``(uid, vid)`` whose full sets are similar enough."""
    docs = pairs.select("uid").unionByName(pairs.select(F.col("vid").alias("uid"))).distinct()
    full = common.stage(_full_sets(keyed, docs, size), "full")
    other = full.select(F.col("uid").alias("vid"), F.col("grams").alias("other"))
    both = F.size(F.array_intersect("grams", "other")).cast("long")
    return (pairs.join(full, "uid").join(other, "vid")
            .where(100 * both >= percent * (F.size("grams") + F.size("other") - both))
            .select("uid", "vid"))


def near_duplicates(docs: DataFrame, size: int, percent: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(uid, doc_id, n_shingles, component_id)`` per document.

    A set holds the distinct ``size``-word n-grams of the text, A-Z in lower case; a text with fewer words
    has their whole sequence as its one element. Two documents link when their sets' Jaccard
    similarity is at least ``percent`` / 100, and ``component_id`` is the smallest id that links
    lead to. NULL and empty texts have an empty set and link with nothing. Rows with NULL or
    repeated ids are documents of their own. N-grams are compared by 64-bit hashes.
    """
    return classes_of(common.keyed(docs, id_col, text_col), size, percent)


def classes_of(keyed: DataFrame, size: int, percent: int) -> DataFrame:
    """``near_duplicates`` of the output of ``common.keyed``."""
    sets = document_sets(keyed, size, percent)
    same = ["n", "s1", "s2"]
    classes = common.stage(sets.where("n > 0").groupBy(*same).agg(F.min("uid").alias("rep")), "classes")
    reps = sets.join(classes.select(F.col("rep").alias("uid")), "uid", "left_semi")
    rows = reps.select("uid", "n", F.posexplode("prefix").alias("p", "gram"))
    often = rows.groupBy("gram").agg(F.count("*").alias("f")).where("f > 1")
    shared = common.stage(rows.join(common.stage(often, "often"), "gram"), "shared")

    signs = sets.select("uid", *[F.col("sign")[i].alias(f"a{i}") for i in range(SIGN)])
    others = signs.toDF("vid", *[f"b{i}" for i in range(SIGN)])
    length, place, close = _similar(percent)

    # round 1: with the document whose prefix n-grams are the most frequent ones
    score = shared.groupBy("uid").agg((F.sum("f") / F.max("n")).alias("score"))
    hub = (shared.join(score, "uid").groupBy("gram").agg(F.max(F.struct(
        "score", (-F.col("uid")).alias("first"), F.col("n").alias("m"), F.col("p").alias("q"))).alias("h"))
        .select("gram", (-F.col("h.first")).alias("vid"), "h.m", "h.q"))
    pairs = (shared.join(hub, "gram").where((F.col("uid") != F.col("vid")) & length & place)
             .select(F.least("uid", "vid").alias("uid"), F.greatest("uid", "vid").alias("vid"),
                     F.when(F.col("uid") < F.col("vid"), F.col("n")).otherwise(F.col("m")).alias("n"),
                     F.when(F.col("uid") < F.col("vid"), F.col("m")).otherwise(F.col("n")).alias("m"))
             .distinct().join(signs, "uid").join(others, "vid").where(close).select("uid", "vid"))
    links = common.stage(_verified(common.stage(pairs, "pairs"), keyed, size, percent), "links")
    roots = components(links)

    # round 2: between components; of an n-gram's largest component only with the rest
    part = shared.join(roots.withColumnRenamed("node", "uid"), "uid", "left").select(
        "gram", "uid", "n", "p", F.coalesce("root", "uid").alias("part"))
    largest = (part.groupBy("gram", "part").agg(F.count("*").alias("k")).groupBy("gram")
               .agg(F.max(F.struct("k", "part")).alias("top"), F.count("*").alias("parts"))
               .where("parts > 1").select("gram", F.col("top.part").alias("top")))
    open_ = common.stage(part.join(largest, "gram").join(signs, "uid"), "open")
    right = open_.select("gram", F.col("uid").alias("vid"), F.col("n").alias("m"), F.col("p").alias("q"),
                         F.col("part").alias("vpart"), (F.col("part") == F.col("top")).alias("big"),
                         *[F.col(f"a{i}").alias(f"b{i}") for i in range(SIGN)])
    left = open_.where("part <> top")
    more = (left.join(right, (left["gram"] == right["gram"]) & (F.col("part") != F.col("vpart"))
                      & (F.col("big") | (F.col("uid") < F.col("vid"))) & length & place & close)
            .select(F.least("uid", "vid").alias("uid"), F.greatest("uid", "vid").alias("vid")).distinct())
    more = common.stage(more, "pairs")
    if not more.isEmpty():
        late = common.stage(_verified(more, keyed, size, percent), "links")
        roots = components(links.unionByName(late))

    named = keyed.select("uid", "id")
    return (named.join(sets.select("uid", *same), "uid").join(classes, same, "left")
            .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .withColumn("first", F.coalesce("root", "rep", "uid"))
            .join(named.select(F.col("uid").alias("first"), F.col("id").alias("component_id")), "first")
            .select("uid", F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"),
                    "component_id", F.col("first").alias("first_uid")))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), 3, 90).drop("uid", "first_uid")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + 2], ' ') AS g FROM
  (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS s FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM g a JOIN g b USING (g)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * k >= 90 * (a.n + b.n - k)),
r AS (SELECT doc_id AS x, doc_id AS c FROM d UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM d JOIN r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n
"""
