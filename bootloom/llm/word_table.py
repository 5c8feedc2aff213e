"""Byte-level BPE through a table of distinct words, and back through a table of pieces.

A text may be cut before any white space that follows a printed character without changing its ids; what lies
between two cuts is a word here. Words repeat, so a document is kept as positions in a list: each slice of some MB
of text has a sorted list of its distinct words. Only the lists are shuffled, cut by word hash into compressed
pieces: where the lists of a hash bucket meet, each distinct word is encoded once, and its ids are decoded by a
join with the table of the vocabulary's pieces. Both go back to the slices in the order of their lists, and
documents are put together by position.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import bpe, common, fsio
from .textops import U, hash_spans, slices, text_bytes
from .token_counts import tokenizer_path

SLICE_BYTES = 8 << 20
SLICE_ROWS = 1 << 16
WORDS_AT_ONCE = 4096
WAVES = 4        # rounds the buckets are taken in; only the lists of one are shuffled at a time


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte offset and length of each word, and the number of words by text. The words of a text are all of it."""
    blank = np.flatnonzero(bpe.BLANK[data]) if len(data) else np.zeros(0, np.int64)
    blank = blank[blank > 0]
    begins = np.zeros(len(data), bool)
    begins[blank[bpe.solid_before(data, blank)]] = True
    begins[offs[:-1][offs[1:] > offs[:-1]]] = True
    start = np.flatnonzero(begins)
    return start, np.diff(np.append(start, len(data))), np.diff(np.searchsorted(start, offs))


def distinct_words(data: np.ndarray, start: np.ndarray, length: np.ndarray, buckets: int):
    """(distinct words, their hash buckets, the place of each word among them); words are in order of bucket, then
    bytes."""
    if not len(start):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, second = hash_spans(data, start, length), hash_spans(data, start, length, 1)
    order = np.argsort(first)
    fresh = np.append(True, first[order][1:] != first[order][:-1])
    at = order[fresh]
    number = np.empty(len(first), np.int64)
    number[order] = np.cumsum(fresh) - 1
    view = memoryview(np.ascontiguousarray(data))
    if (second[at][number] != second).any():   # two words of one hash: tell them apart by their bytes
        every = [view[s:s + n].tobytes() for s, n in zip(start, length)]
        place = {w: i for i, w in enumerate(dict.fromkeys(every))}
        words, number = list(place), np.array([place[w] for w in every], np.int64)
        at = np.unique(number, return_index=True)[1]
    else:
        words = [view[s:s + n].tobytes() for s, n in zip(start[at], length[at])]
    bucket = (first[at] % U(buckets)).astype(np.int64)
    by = sorted(range(len(words)), key=lambda i: (bucket[i], words[i]))
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    return [words[i] for i in by], bucket[by], rank[number]


# ------------------------------------------------------------------ compressed numbers and bytes

def _shrunk(values: np.ndarray) -> bytes:
    """Non-negative integers: byte by byte of all, the lowest first, compressed."""
    wide = 4 if len(values) and values.max() >= 1 << 16 else 2
    planes = np.ascontiguousarray(values.astype(f"<u{wide}").view(np.uint8).reshape(-1, wide).T)
    return bytes([wide]) + pa.compress(planes.tobytes(), "zstd", asbytes=True) if len(values) else b""


def _restored(raw: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(raw[1:], n * raw[0], "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(raw[0], n).T).view(f"<u{raw[0]}").ravel().astype(np.int64)


def _squeezed(raw: bytes) -> bytes:
    return pa.compress(raw, "zstd", asbytes=True) if raw else b""


def _expanded(raw: bytes, n: int) -> bytes:
    return pa.decompress(raw, n, "zstd", asbytes=True) if n else b""


def _gathered(pool: np.ndarray, sizes: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The stretches ``pick`` of a pool, whose stretches have the given sizes."""
    begin, count = (np.cumsum(sizes) - sizes)[pick], sizes[pick]
    ends = np.cumsum(count)
    return pool[np.repeat(begin - ends + count, count) + np.arange(ends[-1])] if len(pick) else pool[:0]


# ------------------------------------------------------------------ the tables

def coded_slices(docs: DataFrame, id_col: str, text_col: str, most: int, buckets: int) -> DataFrame:
    """``(slice, ids, counts, n, codes, lists)``, written: documents as positions in their slice's list of n words,
    and the list by hash bucket. What a task wrote is what counts, so a repeated task may cut other slices."""
    df = common.pick(docs, doc_id=id_col, text=F.coalesce(common._column(text_col).cast("string"), F.lit("")))
    kind = T.StructType([
        T.StructField("slice", T.LongType()), T.StructField("ids", T.ArrayType(df.schema["doc_id"].dataType)),
        T.StructField("counts", T.ArrayType(T.IntegerType())), T.StructField("n", T.IntegerType()),
        T.StructField("codes", T.BinaryType()), T.StructField("lists", T.ArrayType(T.StructType.fromDDL(LIST)))])
    arrow = to_arrow_schema(kind)

    def work(batches):
        number = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "text", most, SLICE_ROWS):
            data, offs = text_bytes(batch.column("text"))
            start, length, counts = word_spans(data, offs)
            words, bucket, codes = distinct_words(data, start, length, buckets)
            lists = []
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(words) else []
            for a, b in zip(cut, np.append(cut[1:], len(words)) if len(words) else []):
                sizes = np.array([len(w) for w in words[a:b]], np.int64)
                lists.append({"bucket": int(bucket[a]), "size": int(b - a), "length": int(sizes.sum()),
                              "lengths": _shrunk(sizes), "words": _squeezed(b"".join(words[a:b]))})
            rows = pa.array([0, batch.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.array([number]), pa.ListArray.from_arrays(rows, batch.column("doc_id")),
                pa.ListArray.from_arrays(rows, pa.array(counts.astype(np.int32))),
                pa.array([len(words)], pa.int32()), pa.array([_shrunk(codes)], pa.binary()),
                pa.array([lists], arrow.field("lists").type)], schema=arrow)
            number += 1

    return common.stage(df.mapInArrow(work, kind), "coded")


LIST = "bucket int, size int, length long, lengths binary, words binary"
# Ids of a list's words, and the decoded bytes of those (``other``) that don't decode to their own bytes.
ANSWER = ("slice long, bucket int, n int, counts binary, tokens binary, other binary, n_other int, lengths binary, "
          "length long, text binary")


def answered_lists(lists: DataFrame, tokenizer: str, pieces: DataFrame) -> DataFrame:
    """``ANSWER`` rows, one per ``(slice, bucket, size, length, lengths, words)``.

    The distinct words of a bucket are encoded once each, and their ids joined with ``pieces(token, piece)``, which has
    one row per id of the vocabulary and is sent to all tasks. Every word is decoded so and compared; as a slice has
    its own words, only bytes that differ go back to it.
    """
    arrow = to_arrow_schema(T.StructType.fromDDL(ANSWER))
    table = pieces.toArrow()
    shared = lists.sparkSession.sparkContext.broadcast(
        tuple(table[c].combine_chunks() for c in ("token", "piece")))   # bounded by the vocabulary

    def work(table: pa.Table) -> pa.Table:
        encoder, known, places = bpe.load(tokenizer), {}, []
        rows = table.select(["slice", "size", "length", "lengths", "words"]).to_pylist()
        for row in rows:
            own = _cut(_expanded(row["words"], row["length"]), np.cumsum(_restored(row["lengths"], row["size"])))
            places.append(np.array([known.setdefault(w, len(known)) for w in own], np.int64))
        words, ids = list(known), []
        for at in range(0, len(words), WORDS_AT_ONCE):
            ids += encoder.whole([w.decode() for w in words[at:at + WORDS_AT_ONCE]])
        counts = np.array([len(x) for x in ids], np.int64)
        tokens = np.fromiter((i for x in ids for i in x), np.int64, int(counts.sum()))
        decoded, lengths = _joined(tokens, counts, *shared.value)
        differs = _differing(decoded, lengths, b"".join(words), np.array([len(w) for w in words], np.int64))
        pool, bucket = np.frombuffer(decoded, np.uint8), table["bucket"][0].as_py()
        out = []
        for row, pick in zip(rows, places):
            other = np.flatnonzero(differs[pick])
            mine = _gathered(pool, lengths, pick[other]).tobytes()
            out.append((row["slice"], bucket, row["size"], _shrunk(counts[pick]), _shrunk(_gathered(tokens, counts, pick)),
                        _shrunk(other), len(other), _shrunk(lengths[pick[other]]), len(mine), _squeezed(mine)))
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out), arrow)], schema=arrow)

    return lists.groupBy("bucket").applyInArrow(work, ANSWER)


def _joined(tokens: np.ndarray, counts: np.ndarray, known: pa.Array, pieces: pa.Array) -> tuple[bytes, np.ndarray]:
    """(decoded bytes of all words behind one another, their lengths): each id joined with its piece."""
    at = pc.index_in(pa.array(tokens, known.type), value_set=known)
    if at.null_count:
        raise RuntimeError("the vocabulary lacks an id")
    found = pieces.take(at)
    ends = np.append(0, np.cumsum(np.array(pc.binary_length(found), np.int64)))
    upto = ends[np.append(0, np.cumsum(counts))]
    return b"".join(found.to_pylist()), np.diff(upto)


def _differing(one: bytes, one_sizes: np.ndarray, two: bytes, two_sizes: np.ndarray) -> np.ndarray:
    """Which of as many stretches differ."""
    if one == two and (one_sizes == two_sizes).all():
        return np.zeros(len(one_sizes), bool)
    a, b = np.append(0, np.cumsum(one_sizes)).tolist(), np.append(0, np.cumsum(two_sizes)).tolist()
    return np.array([one[a[i]:a[i + 1]] != two[b[i]:b[i + 1]] for i in range(len(one_sizes))], bool)


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in the pieces of byte-level vocabularies: printed Latin-1
    characters stand for themselves, the other bytes are numbered from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


def piece_table(spark: SparkSession, tokenizer: str) -> DataFrame:
    """``(token, piece)``: the bytes an id decodes to. A piece with a character that stands for no byte (an added
    token, say) is its own UTF-8 bytes. One row per id, so its size is the vocabulary's."""
    encoder, back = bpe.load(tokenizer), {c: b for b, c in byte_alphabet().items()}
    pieces = ((i, encoder.tokenizer.id_to_token(i)) for i in range(encoder.size))
    return spark.createDataFrame(
        [(i, bytearray(back[c] for c in p) if all(c in back for c in p) else bytearray(p.encode()))
         for i, p in pieces if p is not None], "token int, piece binary")


def _check(tokenizer: str) -> None:
    with open(tokenizer, encoding="utf-8") as f:
        decoder = json.load(f).get("decoder") or {}
    if not bpe.load(tokenizer).byte_level or decoder.get("type") != "ByteLevel":
        raise ValueError("words can be encoded apart from each other with plain byte-level BPE files only")


def encode_and_decode(docs: DataFrame, tokenizer: str, what, columns: str, id_col: str = "doc_id",
                      text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``what(ids, decoded)`` of each document, ``ids`` as bytes of little-endian 32-bit integers and ``decoded`` as
    the bytes its ids stand for, as ``(doc_id, *columns)``: one row per input row.

    NULL and empty texts have no ids. Special strings in a text become their ids, as in the library by default. NULL or
    repeated ids are passed on; rows need no id to find back to their words. Other columns are left out.
    A task holds a slice, some 8 MB of text or one text that is longer, or the words of one hash bucket, of which
    there are as many as shuffle partitions. The answers of a slice are a file in the shared scratch folder.
    """
    _check(tokenizer)
    spark = docs.sparkSession
    coded = coded_slices(docs, id_col, text_col, slice_bytes, common.parts(spark))
    lists = coded.select("slice", F.explode("lists").alias("l")).select("slice", "l.*")
    pieces = piece_table(spark, tokenizer)
    folder = common.folder(spark, "answers")
    fsio.make_folder(folder)

    def write(table: pa.Table) -> pa.Table:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        fsio.write_whole(_place(folder, table["slice"][0].as_py(), table["bucket"][0].as_py()), sink.getvalue().to_pybytes())
        return table.select(["slice"]).slice(0, 1)

    for wave in range(WAVES):   # all buckets, a part of them at a time
        answers = answered_lists(lists.where(F.col("bucket") % WAVES == wave), tokenizer, pieces)
        common.stage(answers.groupBy("slice").applyInArrow(write, "slice long"), "answered")
    kind = T.StructType([T.StructField("doc_id", coded.schema["ids"].dataType.elementType),
                         *T.StructType.fromDDL(columns).fields])
    arrow = to_arrow_schema(kind)

    def assemble(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at] for c in batch.schema.names}
                counts = np.array(row["counts"].as_py(), np.int64)
                ids, text = (_answered(folder, row["slice"].as_py(), row["lists"].as_py()) if row["n"].as_py()
                             else ([], []))
                ends = np.cumsum(counts)
                codes = _restored(row["codes"].as_py(), int(ends[-1])).tolist()
                out = [what(b"".join([ids[c] for c in codes[a:b]]), b"".join([text[c] for c in codes[a:b]]))
                       for a, b in zip(ends - counts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [row["ids"].values, *[pa.array(x, f.type) for x, f in zip(zip(*out), list(arrow)[1:])]], schema=arrow)

    return coded.mapInArrow(assemble, kind)


def _place(folder: str, number: int, bucket: int) -> str:
    """The file with a slice's answers for the wave of a bucket."""
    return f"{folder}/{number}-{bucket % WAVES}"


def _answered(folder: str, number: int, lists: list[dict]) -> tuple[list[bytes], list[bytes]]:
    """(ids, decoded bytes) of the words of a slice, in the order of its lists."""
    rows = []
    for uri in sorted({_place(folder, number, own["bucket"]) for own in lists}):
        with fsio.open_in(uri) as f:
            rows += pa.ipc.open_stream(f.read()).read_all().to_pylist()
    rows.sort(key=lambda r: r["bucket"])
    ids, text = [], []
    for row, own in zip(rows, lists, strict=True):
        ends = 4 * np.cumsum(_restored(row["counts"], row["n"]))
        ids += _cut(_restored(row["tokens"], int(ends[-1]) // 4).astype("<u4").tobytes(), ends)
        words = _cut(_expanded(own["words"], own["length"]), np.cumsum(_restored(own["lengths"], own["size"])))
        other = _restored(row["other"], row["n_other"])
        changed = _cut(_expanded(row["text"], row["length"]), np.cumsum(_restored(row["lengths"], row["n_other"])))
        for i, w in zip(other.tolist(), changed):
            words[i] = w
        text += words
    return ids, text


def _cut(raw: bytes, ends: np.ndarray) -> list[bytes]:
    ends = ends.tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


def digests(ids: bytes, decoded: bytes) -> tuple[int, str, str]:
    """Number of ids, and SHA-256 of the ids and of the decoded text. Bytes that are no UTF-8 decode to U+FFFD."""
    text = decoded.decode("utf-8", "replace").encode()
    return len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()


def op13_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_and_decode(common.table(spark, sf_dir, "documents"), tokenizer_path(), digests,
                             "n_tokens long, ids_sha256 string, decoded_sha256 string")
