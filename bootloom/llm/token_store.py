"""Token ids in raw binary shards, with a minimal perfect hash index from document key to place.

Layout of a folder::

    ids-<name>.bin        raw little-endian ids, uint16 where the vocabulary fits, else uint32
    index/mph-<k>.bin     hash index, see ``pack_index``
    shards/, repeats/     Parquet: the shard files in order; later records of repeated keys
    manifest.json         sizes

A key lookup hashes the key, takes index file and bucket from the hash, finds its slot by the
bucket's minimal perfect hash, compares the stored fingerprint and has shard, offset and length.
"""

from __future__ import annotations

import json
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, common, fsio
from .textops import mix, slices, text_bytes
from .token_counts import encode_batch, tokenizer_path

END = 0
BUCKET_KEYS = 512            # keys of a bucket on average
FILE_KEYS = (4096, 1 << 20)  # keys of an index file: few while there are under FILES files
FILES = 1024
GAMMA = 1.6                  # bits of a level per key that is still without a place
LEVELS = 48
SLOT = np.dtype([("fingerprint", "<u8"), ("shard", "<u4"), ("offset", "<u8"), ("length", "<u4")])
STEP = 0x9E3779B97F4A7C15


def key_hash(key) -> tuple[int, int]:
    """Two 64-bit hashes of a key; integers and their decimal strings are the same key."""
    h = xxhash.xxh3_128_intdigest(b"\0null" if key is None else str(key).encode())
    return h >> 64, h & (2 ** 64 - 1)


# ------------------------------------------------------------------ minimal perfect hash

def build_mph(low: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Bit levels, the slot of each key, and which keys no level could place (equal hashes)."""
    live = np.arange(len(low))
    slot = np.full(len(low), -1, np.int64)
    levels, taken = [], 0
    for level in range(LEVELS):
        if not len(live):
            break
        size = -(-int(len(live) * GAMMA + 1) // 64) * 64
        place = _place(low[live], level, size)
        alone = np.bincount(place, minlength=size) == 1
        levels.append(alone)
        hit = alone[place]
        slot[live[hit]] = taken + (np.cumsum(alone) - 1)[place[hit]]
        taken += int(alone.sum())
        live = live[~hit]
    slot[live] = taken + np.arange(len(live))
    return levels, slot, live


def _place(low, level: int, size: int) -> np.ndarray:
    return (mix(low + np.uint64(STEP * (level + 1) % 2 ** 64)) % np.uint64(size)).astype(np.int64)


def find_mph(levels: list[np.ndarray], low: np.ndarray, extra: np.ndarray) -> np.ndarray:
    """Slots; of a key that was not built in, any slot or -1."""
    slot = np.full(len(low), -1, np.int64)
    live, taken = np.arange(len(low)), 0
    for level, bits in enumerate(levels):
        place = _place(low[live], level, len(bits))
        hit = bits[place]
        slot[live[hit]] = taken + (np.cumsum(bits) - 1)[place[hit]]
        taken += int(bits.sum())
        live = live[~hit]
    for i in live:
        same = np.flatnonzero(extra == low[i])
        slot[i] = taken + same[0] if len(same) else -1
    return slot


def pack_bucket(low: np.ndarray, slots: np.ndarray) -> bytes:
    """One bucket: counts, level sizes, level bits, unplaced hashes, slots in hash order."""
    levels, slot, extra = build_mph(low)
    ordered = np.zeros(len(low), SLOT)
    ordered[slot] = slots
    sizes = [len(x) for x in levels]
    head = np.array([len(low), len(levels), len(extra), *sizes], "<u4")
    return b"".join([head.tobytes(), *[np.packbits(x, bitorder="little").tobytes() for x in levels],
                     low[extra].astype("<u8").tobytes(), ordered.tobytes()])


def unpack_bucket(raw: bytes):
    n, n_levels, n_extra = np.frombuffer(raw, "<u4", 3).tolist()
    sizes = np.frombuffer(raw, "<u4", n_levels, 12).tolist()
    at, levels = 12 + 4 * n_levels, []
    for size in sizes:
        levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, size // 8, at),
                                    bitorder="little").astype(bool))
        at += size // 8
    extra = np.frombuffer(raw, "<u8", n_extra, at)
    return levels, extra, np.frombuffer(raw, SLOT, n, at + 8 * n_extra)


def find_in_bucket(raw: bytes, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are there by their fingerprint, and their slots."""
    levels, extra, slots = unpack_bucket(raw)
    slot = find_mph(levels, low, extra)
    found = slot >= 0
    if len(slots):
        found &= slots["fingerprint"][slot] == high
    return found, slots[np.maximum(slot, 0)] if len(slots) else np.zeros(len(slot), SLOT)


def pack_index(bucket: np.ndarray, n_buckets: int, low: np.ndarray, slots: np.ndarray) -> bytes:
    """One index file: n_buckets + 1 byte offsets, then the buckets."""
    order = np.lexsort([low, bucket])
    bucket, low, slots = bucket[order], low[order], slots[order]
    cut = np.searchsorted(bucket, np.arange(n_buckets + 1))
    blobs = [pack_bucket(low[a:b], slots[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    ends = np.cumsum([8 * (n_buckets + 1), *[len(x) for x in blobs]])
    return ends.astype("<u8").tobytes() + b"".join(blobs)


# ------------------------------------------------------------------ writing

@dataclass(frozen=True)
class Layout:
    files: int
    buckets: int  # of a file

    @classmethod
    def of(cls, n_keys: int) -> "Layout":
        files = max(-(-n_keys // FILE_KEYS[1]), min(-(-n_keys // FILE_KEYS[0]), FILES), 1)
        return cls(files, max(1, -(-n_keys // (files * BUCKET_KEYS))))

    def place(self, high):
        """(file, bucket of the file) by the high hash."""
        total = np.uint64(self.files * self.buckets)
        bucket = (np.asarray(high, np.uint64) >> np.uint64(7)) % total
        return (bucket // np.uint64(self.buckets)).astype(np.int64), (
            bucket % np.uint64(self.buckets)).astype(np.int64)


def write_store(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id",
                text_col: str = "text", end_id: int | None = END, n_shards: int | None = None):
    """Encode every text and write ids and index below ``folder``; rows go in ascending id order.

    NULL text is empty: its record is the end id alone. A NULL id is a key of its own and comes
    first. Where an id repeats, every row is written; the index holds the first record and
    ``repeats`` the others. Other columns are left out. A repeated or lost task writes a new
    shard file, and only files of tasks that ended are named in the index.
    """
    spark = docs.sparkSession
    fsio.make_folder(f"{folder}/index")
    n = n_shards or common.parts(spark)
    vocabulary = bpe.load(tokenizer).size
    kind = "<u2" if max(vocabulary, (end_id or 0) + 1) <= 1 << 16 else "<u4"
    # rows of one id go by the hash of their text, so that an id of any number of rows is spread
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = (common.pick(docs, id=id_col, text=F.coalesce(common._column(text_col).cast("string"), F.lit("")))
            .repartitionByRange(n, *order).sortWithinPartitions(*order))

    def write(batches):
        encoder, out, at, part = bpe.load(tokenizer), None, 0, TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex[:12]}.bin"
        for batch in slices(batches, "text", bpe.SLICE):
            if out is None:
                out = fsio.open_out(f"{folder}/{name}")
            ids, counts = encode_batch(encoder, *text_bytes(batch.column("text")))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(counts), end_id)
                counts = counts + 1
            out.write(ids.astype(kind).tobytes())
            keys = [key_hash(k) for k in batch.column("id").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * len(counts), pa.int64()), pa.array([name] * len(counts)),
                pa.array(at + np.cumsum(counts) - counts), pa.array(counts),
                pa.array(np.array([h for h, _ in keys], np.uint64).view(np.int64)),
                pa.array(np.array([h for _, h in keys], np.uint64).view(np.int64))],
                names=["part", "file", "offset", "length", "high", "low"])
            at += int(counts.sum())
        if out is not None:
            out.close()

    records = common.stage(rows.mapInArrow(
        write, "part long, file string, offset long, length long, high long, low long"), "records")
    # one row for each shard file, of which there are n
    shards = (records.groupBy("file").agg(F.first("part").alias("part"), F.sum("length").alias("ids"),
                                          F.count("*").alias("docs"))
              .toPandas().sort_values("part", ignore_index=True))
    shards["shard"] = np.arange(len(shards))
    shards["start"] = shards["ids"].cumsum() - shards["ids"]
    files = common.local(spark, shards, "file string, part long, ids long, docs long, shard long, start long")
    files.coalesce(1).write.parquet(f"{folder}/shards")
    n_keys = int(shards["docs"].sum())
    layout = Layout.of(n_keys)

    numbered = records.join(F.broadcast(files.select("file", "shard")), "file")  # n rows
    place = F.struct("shard", "offset", "length")
    firsts = numbered.groupBy("high", "low").agg(F.min(place).alias("p"), F.count("*").alias("n"))
    firsts = common.stage(firsts.select("high", "low", "p.*", "n"), "keys")
    again = firsts.where("n > 1").select("high", "low", *[F.col(c).alias(f"first_{c}")
                                                           for c in ("shard", "offset")])
    (numbered.join(again, ["high", "low"])
     .where("shard <> first_shard OR offset <> first_offset")
     .select("high", "low", "shard", "offset", "length").write.parquet(f"{folder}/repeats"))

    def index(pdf):
        high, low = pdf["high"].to_numpy().view(np.uint64), pdf["low"].to_numpy().view(np.uint64)
        slots = np.zeros(len(pdf), SLOT)
        slots["fingerprint"] = high
        for c in ("shard", "offset", "length"):
            slots[c] = pdf[c].to_numpy()
        file, bucket = layout.place(high)
        fsio.write_whole(f"{folder}/index/mph-{file[0]:06d}.bin",
                         pack_index(bucket, layout.buckets, low, slots))
        return pd.DataFrame({"file": [int(file[0])], "n": [len(pdf)]})

    built = firsts.withColumn("file", _file_column(layout)).groupBy("file").applyInPandas(
        index, "file long, n long").agg(F.sum("n")).first()[0] or 0
    fsio.write_whole(f"{folder}/manifest.json", json.dumps(
        {"kind": kind, "keys": int(built), "records": n_keys, "ids": int(shards["ids"].sum()),
         "files": layout.files, "buckets": layout.buckets}).encode())
    return TokenStore(spark, folder)


def _file_column(layout: Layout):
    """``Layout.place`` in SQL: the shift makes the hash a non-negative long."""
    total = layout.files * layout.buckets
    return F.floor((F.shiftrightunsigned("high", 7) % F.lit(total)) / F.lit(layout.buckets))


# ------------------------------------------------------------------ reading

class TokenStore:
    """A written folder: keyed access on the driver (``get``) or for tables of keys."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        with fsio.open_in(f"{folder}/manifest.json") as f:
            self.manifest = json.loads(f.read())
        self.layout = Layout(self.manifest["files"], self.manifest["buckets"])
        self.shards = spark.read.parquet(f"{folder}/shards").orderBy("shard").toPandas()

    def get(self, key) -> np.ndarray | None:
        """Ids of one document: three short reads, however large the store is."""
        high, low = (np.array([h], np.uint64) for h in key_hash(key))
        file, bucket = (int(x[0]) for x in self.layout.place(high))
        uri = f"{self.folder}/index/mph-{file:06d}.bin"
        if not self.manifest["keys"] or not _exists(uri):
            return None
        with fsio.open_in(uri) as f:
            a, b = np.frombuffer(f.read_at(16, 8 * bucket), "<u8").tolist()
            found, slot = find_in_bucket(f.read_at(b - a, a), high, low)
        if not found[0]:
            return None
        width = np.dtype(self.manifest["kind"]).itemsize
        with fsio.open_in(f"{self.folder}/{self.shards['file'][int(slot['shard'][0])]}") as f:
            raw = f.read_at(int(slot["length"][0]) * width, int(slot["offset"][0]) * width)
        return np.frombuffer(raw, self.manifest["kind"]).astype(np.uint32)

    def find(self, keys: DataFrame) -> DataFrame:
        """``(key, shard, offset, length)`` for a table with a column ``key`` of distinct keys:
        one row per record of a key; keys that are not there have none."""
        folder, layout = self.folder, self.layout

        def hashes(batches):
            for batch in batches:
                h = [key_hash(k) for k in batch.column("key").to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column("key"), pa.array(np.array([x for x, _ in h], np.uint64).view(np.int64)),
                    pa.array(np.array([x for _, x in h], np.uint64).view(np.int64))],
                    names=["key", "high", "low"])

        def look(pdf):
            high, low = pdf["high"].to_numpy().view(np.uint64), pdf["low"].to_numpy().view(np.uint64)
            file, bucket = layout.place(high)
            parts = []
            with fsio.open_in(f"{folder}/index/mph-{file[0]:06d}.bin") as f:
                raw = f.read()
            ends = np.frombuffer(raw, "<u8", layout.buckets + 1)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(layout.buckets + 1))
            for b in np.unique(bucket):
                rows = order[cut[b]:cut[b + 1]]
                found, slot = find_in_bucket(raw[int(ends[b]):int(ends[b + 1])], high[rows], low[rows])
                part = pdf.iloc[rows[found]][["key"]].copy()
                for c in ("shard", "offset", "length"):
                    part[c] = slot[found][c].astype(np.int64)
                parts.append(part)
            return pd.concat(parts)

        kind = keys.schema["key"].dataType.simpleString()
        hashed = keys.select("key").mapInArrow(hashes, f"key {kind}, high long, low long")
        if not self.manifest["keys"]:
            return hashed.select("key", *[F.lit(0).cast("long").alias(c)
                                          for c in ("shard", "offset", "length")]).where("false")
        first = hashed.withColumn("file", _file_column(layout)).groupBy("file").applyInPandas(
            look, f"key {kind}, shard long, offset long, length long")
        if self.manifest["keys"] == self.manifest["records"]:
            return first
        repeats = self.spark.read.parquet(f"{folder}/repeats")
        return first.unionByName(repeats.join(hashed, ["high", "low"])
                                 .select("key", "shard", "offset", "length"))

    def payloads(self, places: DataFrame, what, columns: str) -> DataFrame:
        """Apply ``what(ids) -> tuple`` to each record of ``(key, shard, offset, length)``; reads
        of neighbouring records are joined. ``start`` counts the ids of all records before."""
        folder, width = self.folder, np.dtype(self.manifest["kind"]).itemsize
        files, kind = self.shards["file"].tolist(), self.manifest["kind"]
        starts = self.shards["start"].to_numpy(np.int64)
        names = [c.split()[0] for c in columns.split(",")]

        def read(batches):
            for pdf in batches:
                if not len(pdf):
                    continue
                spans = ((f"{folder}/{files[s]}", int(o) * width, int(n) * width)
                         for s, o, n in zip(pdf["shard"], pdf["offset"], pdf["length"]))
                got = [what(np.frombuffer(raw, kind)) for _, raw in fsio.ranged_reads(spans)]
                pdf["start"] = starts[pdf["shard"].to_numpy()] + pdf["offset"]
                for c, values in zip(names, zip(*got)):
                    pdf[c] = values
                yield pdf[["key", "start", "length", *names]]

        key = places.schema["key"].dataType.simpleString()
        return (places.repartitionByRange(common.parts(self.spark), "shard", "offset")
                .sortWithinPartitions("shard", "offset")
                .mapInPandas(read, f"key {key}, start long, length long, {columns}"))


def _exists(uri: str) -> bool:
    system, path = fsio.resolve(uri)
    return system.get_file_info(path).is_file


def ids_crc32(ids: np.ndarray) -> tuple[int]:
    return (zlib.crc32(ids.astype("<u4").tobytes()),)


def stored_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write a store of all documents, look every document up in it and read its ids back."""
    store = write_store(docs, common.folder(docs.sparkSession, "tokens"), tokenizer)
    keys = common.pick(docs, key="doc_id")
    if store.manifest["keys"] != store.manifest["records"]:
        keys = keys.distinct()
    return store.payloads(store.find(keys), ids_crc32, "ids_crc32 long").select(
        F.col("key").alias("doc_id"), "start", F.col("length").alias("n_tokens"), "ids_crc32")


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_digests(common.table(spark, sf_dir, "documents"), tokenizer_path())
