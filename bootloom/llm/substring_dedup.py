"""Removal of passages that occurred before, found by level-wise doubling.

Windows are first looked at by some five words of theirs, then by twice as many, and so on to the full length; what
does not occur twice at one length is not looked at at the next, and without candidates it ends there. Not all
shorter windows are looked at: of those within a full window the one with the smallest hash, its anchor,
which equal windows share. Repeats at the full length decide what goes.

What meets by hash is counted by aggregation, with partial counts on the map side, and joined back, so that a passage
that a third of all documents share is one row of the counts per task, and a skewed side that Spark can split.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .textops import Words, find_words, hash_spans, mix, ngrams, signed, slices, text_bytes

LENGTH = 20
START = 5      # words of the first level, or up to twice as many where halving does not come out


def levels(length: int) -> list[int]:
    """The lengths that are looked at; each is at most twice the one before."""
    out = [length]
    while out[0] >= 2 * START:
        out.insert(0, -(-out[0] // 2))
    return out


def _anchors(words: Words, h: np.ndarray, length: int, part: int):
    """Window starts, and for each the place of its anchor of ``part`` words; hashes of all such parts."""
    grams = ngrams(h, part)
    starts = np.arange(max(0, len(h) - length + 1))
    starts = starts[words.doc[starts] == words.doc[starts + length - 1]]
    if not len(starts):
        return starts, starts, grams
    span = np.lib.stride_tricks.sliding_window_view(grams, length - part + 1)
    return starts, starts + span[starts].argmin(axis=1), grams


def _alive(batch, words: Words, h: np.ndarray, length: int, part: int) -> np.ndarray:
    """Starts of the windows whose anchor of ``part`` words is in the row's list ``anchors``."""
    starts, place, grams = _anchors(words, h, length, part)
    lists = batch.column("anchors")
    owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    wanted = mix(lists.flatten().to_numpy().view(np.uint64)) + owner.astype(np.uint64)
    return starts[np.isin(mix(grams[place]) + words.doc[place].astype(np.uint64), wanted)]


def _prepared(batch):
    data, offs = text_bytes(batch.column("text"))
    words = find_words(data, offs)
    return data, words, hash_spans(data, words.start, words.length)


def _digest(data, words: Words, row: int, keep: np.ndarray | None = None) -> str:
    a, b = words.first[row], words.first[row + 1]
    if a == b:
        return hashlib.sha256(b"").hexdigest()
    raw = data[words.start[a]:words.start[b - 1] + words.length[b - 1]].tobytes().split()
    if keep is not None:
        raw = [w for w, k in zip(raw, keep) if k]
    return hashlib.sha256(b" ".join(raw)).hexdigest()


def _rows(schema: dict, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.values())],
                                      names=list(schema))


def _grouped(order_key: np.ndarray, *ties: np.ndarray):
    """Stable order by key then ties, and where each key begins."""
    order = np.lexsort([*ties[::-1], order_key])
    fresh = np.ones(len(order), bool)
    fresh[1:] = order_key[order][1:] != order_key[order][:-1]
    return order, fresh


def document_digests(keyed: DataFrame) -> DataFrame:
    """``(uid, n_words, sha)`` of the whole documents."""
    schema = {"uid": pa.int64(), "n_words": pa.int64(), "sha": pa.string()}

    def work(batches):
        for batch in slices(batches, "text"):
            data, offs = text_bytes(batch.column("text"))
            words = find_words(data, offs)
            yield _rows(schema, batch.column("uid"), words.counts(),
                        [_digest(data, words, i) for i in range(batch.num_rows)])

    return keyed.select("uid", "text").mapInArrow(work, "uid long, n_words long, sha string")


def repeated_anchors(texts: DataFrame, length: int, part: int, before: int | None) -> DataFrame:
    """``(uid, anchors)``, written: the anchors of ``part`` words of each document that occur more than once anywhere.
    With ``before``, ``texts`` has the repeated anchors of that many words, and only windows over one count."""
    schema = {"anchor": pa.int64(), "uid": pa.int64(), "n": pa.int32()}

    def work(batches):
        for batch in slices(batches, "text"):
            _, words, h = _prepared(batch)
            starts, place, grams = _anchors(words, h, length, part)
            if before is not None:
                place = place[np.isin(starts, _alive(batch, words, h, length, before))]
            place = np.unique(place)
            if not len(place):
                continue
            key, doc = grams[place], words.doc[place]
            order, _ = _grouped(key, doc)
            key, doc = key[order], doc[order]
            first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])))
            yield _rows(schema, signed(key[first]), batch.column("uid").to_numpy()[doc[first]],
                        np.diff(np.append(first, len(key))).astype(np.int32))

    def repeated():
        rows = common.stage(texts.mapInArrow(work, "anchor long, uid long, n int"), "anchors")
        often = rows.groupBy("anchor").agg(F.sum("n").alias("total")).where("total > 1").select("anchor")
        return rows.select("anchor", "uid").join(often, "anchor").groupBy("uid").agg(
            F.collect_list("anchor").alias("anchors"))

    return common.settled(texts.sparkSession, "repeated", repeated)


def earlier_windows(texts: DataFrame, length: int, before: int) -> DataFrame:
    """``(uid, starts)``: windows of ``(uid, text, anchors)`` whose words also start earlier; ``anchors`` has the
    repeated ones of ``before`` words. Windows that a slice of a task has already had need no meeting point."""
    schema = {"hash": pa.int64(), "uid": pa.int64(), "start": pa.int32(), "known": pa.list_(pa.int32())}

    def work(batches):
        for batch in slices(batches, "text"):
            _, words, h = _prepared(batch)
            starts = _alive(batch, words, h, length, before)
            if not len(starts):
                continue
            full = ngrams(h, length, 1)[starts]
            uid = batch.column("uid").to_numpy()[words.doc[starts]]
            pos = (starts - words.first[words.doc[starts]]).astype(np.int32)
            order, fresh = _grouped(full, uid, pos)
            first = np.sort(order[fresh])
            yield _rows(schema, signed(full[first]), uid[first], pos[first], [None] * len(first))
            later = order[~fresh]
            if len(later):
                later = later[np.argsort(uid[later], kind="stable")]
                cut = np.flatnonzero(np.append(True, uid[later][1:] != uid[later][:-1]))
                ends = np.append(cut, len(later)).astype(np.int32)
                yield _rows(schema, [None] * len(cut), uid[later[cut]], [None] * len(cut),
                            pa.ListArray.from_arrays(ends, pos[later]))

    rows = common.stage(texts.mapInArrow(work, "hash long, uid long, start int, known array<int>"), "windows")
    here = F.struct("uid", "start")
    firsts = rows.where("hash IS NOT NULL").groupBy("hash").agg(F.min(here).alias("first"), F.count("*").alias("n")).where(
        "n > 1").select("hash", "first")
    later = rows.where("hash IS NOT NULL").join(firsts, "hash").where(here != F.col("first")).select(
        "uid", F.array("start").alias("starts"))
    known = rows.where("hash IS NULL").select("uid", F.col("known").alias("starts"))
    return later.unionByName(known).groupBy("uid").agg(F.flatten(F.collect_list("starts")).alias("starts"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                   text_col: str = "text", with_text: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)``, and with ``with_text`` the kept words.

    A word goes if a window of ``length`` words covers it whose words also start earlier, in a smaller id or
    before in the same document. NULL and empty texts have no words; texts with fewer words than a window stay
    whole. Rows with NULL or repeated ids are documents of their own, in the order of ``common.keyed``. Other
    columns are left out.
    """
    if length < 1:
        raise ValueError("the window needs a word")
    keyed = common.keyed(docs, id_col, text_col)
    whole = common.stage(document_digests(keyed), "digests")
    copies = whole.groupBy("sha", "n_words").agg(F.min("uid").alias("first"), F.count("*").alias("n"))
    copies = whole.join(copies.where("n > 1").drop("n"), ["sha", "n_words"]).where(
        "uid <> first").select("uid")
    # every window of a later copy starts earlier in the first
    texts, before, anchors = keyed.select("uid", "text").join(copies, "uid", "left_anti"), None, None
    for part in levels(length)[:-1] or [length]:
        level = texts if anchors is None else texts.join(anchors, "uid")
        found = repeated_anchors(level, length, part, before)
        if before is None:   # the others are out of it for good
            texts = common.stage(texts.join(found.select("uid"), "uid", "left_semi"), "candidates")
        before, anchors = part, found
        if anchors.isEmpty():
            break
    windows = earlier_windows(texts.join(anchors, "uid"), length, before)
    kind = "uid long, removed long, kept string, words string"
    schema = {"uid": pa.int64(), "removed": pa.int64(), "kept": pa.string(), "words": pa.string()}

    def cut(batches):
        for batch in slices(batches, "text"):
            data, offs = text_bytes(batch.column("text"))
            words = find_words(data, offs)
            lists = batch.column("starts")
            ends = lists.offsets.to_numpy()
            starts = lists.flatten().to_numpy()
            base = ends[0]
            removed, kept, text = [], [], []
            for i in range(batch.num_rows):
                n = words.first[i + 1] - words.first[i]
                s = starts[ends[i] - base:ends[i + 1] - base]
                depth = np.bincount(s, minlength=n + 1)[:n + 1].astype(np.int64)
                depth -= np.bincount(s + length, minlength=n + 1)[:n + 1]
                keep = np.cumsum(depth)[:n] == 0
                removed.append(int(n - keep.sum()))
                kept.append(_digest(data, words, i, keep))
                text.append(b" ".join(w for w, k in zip(data[offs[i]:offs[i + 1]].tobytes().split(), keep)
                                      if k).decode() if with_text else None)
            yield _rows(schema, batch.column("uid"), removed, kept, text)

    changed = texts.join(windows, "uid").mapInArrow(cut, kind)
    gone = copies.join(whole.select("uid", "n_words"), "uid").where(
        F.col("n_words") >= length).select(
        "uid", F.col("n_words").alias("removed"), F.sha2(F.lit("").cast("binary"), 256).alias("kept"),
        F.lit("" if with_text else None).cast("string").alias("words"))
    out = whole.join(changed.unionByName(gone), "uid", "left")
    ids = keyed.select("uid", "id", *(["text"] if with_text else []))
    out = out.join(ids, "uid")
    columns = [F.col("id").alias("doc_id"), "n_words", F.coalesce("removed", F.lit(0)).alias("n_removed"),
               F.coalesce("kept", "sha").alias("kept_sha256")]
    if with_text:
        columns.append(F.when(F.col("removed") > 0, F.col("words")).otherwise(F.col("text")).alias("text"))
    return out.select(*columns)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(common.table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM d WHERE len(w) >= 20),
g AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS g FROM p),
r AS (SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) AS k FROM g)
      WHERE k > 1),
c AS (SELECT DISTINCT doc_id, s + unnest(range(20)) AS i FROM r),
x AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
 sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1),
  lambda i: gone IS NULL OR NOT list_contains(gone, i)), lambda i: w[i]), ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)
"""
