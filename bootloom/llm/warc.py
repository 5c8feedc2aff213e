"""WARC archives: written with revisit records, indexed, and read back by byte ranges.

The index is the first thing any reader makes or is given: one row per record with file, offset,
length, URL and payload digest. A selection of index rows is then read in file order, neighbouring
ranges at once.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common, fsio
from ..functions.scratch import scratch_path

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
FILE_BYTES = 1 << 30
LEVEL = 4
GAP, READ = 1 << 16, 8 << 20
INDEX = ("file string, offset long, length long, record_id string, record_type string, url string, "
         "digest string, payload_bytes long, refers_to string")


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _clean(value: str) -> str:
    """Control characters would end a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def pack_record(kind: str, record_id: str, url: str | None, payload: bytes, size: int, digest: str,
                refers_to: str | None = None, date: str = DATE) -> bytes:
    """One gzip member. A revisit has the HTTP head alone, with the size of the whole payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = head.encode() + (payload if kind == "response" else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {REVISIT}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return press.compress(raw) + press.flush()


def parse_record(raw: bytes) -> dict:
    """Headers of one uncompressed record and its payload."""
    top, _, rest = raw.partition(b"\r\n\r\n")
    names = {}
    for line in top.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        names[name.strip().lower().decode()] = value.strip().decode()
    block = rest[:int(names["content-length"])]
    head, _, payload = block.partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    strip = lambda key: names[key].strip("<>") if key in names else None
    return {"record_type": names["warc-type"], "record_id": strip("warc-record-id"),
            "url": names.get("warc-target-uri"), "refers_to": strip("warc-refers-to"),
            "digest": names.get("warc-payload-digest", "sha1:")[5:] or None, "payload": payload,
            "payload_bytes": int(size[1]) if size else len(payload)}


def _pages(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """Pages with the id that the record refers to, NULL where it is a response."""
    df = common.pick(pages, page_id=id_col, url=url_col,
                     html=F.coalesce(common._column(payload_col).cast("string"), F.lit("")))
    df = df.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    kept = (df.where(F.octet_length("html") >= least).groupBy("digest")
            .agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
            .where("n > 1 AND kept IS NOT NULL").select("digest", "kept"))
    return df.join(kept, "digest", "left").select(
        "page_id", "url", "html",
        F.when((F.octet_length("html") >= least) & ~F.col("page_id").eqNullSafe(F.col("kept")),
               F.col("kept")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", least: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row and return the index (stored below ``folder``).

    Of rows with equal payloads of at least ``least`` bytes, those with the largest id are
    responses and the others revisit that id; smaller payloads are responses. A NULL payload is
    empty, a NULL URL leaves its header out, a NULL id sorts below all others and has an empty
    name. Rows that repeat id and payload are written again. A lost or repeated task writes
    files of new names; the index names the files of tasks that ended.
    """
    fsio.make_folder(folder)

    def write(batches):
        out, at, name = None, 0, ""
        for pdf in batches:
            rows = []
            for page, url, html, refers in zip(*(pdf.column(c).to_pylist()
                                                 for c in ("page_id", "url", "html", "refers_to"))):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name = (f"{folder}/part-{TaskContext.get().partitionId():06d}-"
                            f"{uuid.uuid4().hex[:12]}.warc.gz")
                    out, at = fsio.open_out(name), 0
                payload = html.encode()
                digest, kind = sha1_base32(payload), "response" if refers is None else "revisit"
                target = None if refers is None else f"urn:page:{refers}"
                record_id = f"urn:page:{'' if page is None else page}"
                raw = pack_record(kind, record_id, url, payload, len(payload), digest, target)
                out.write(raw)
                rows.append((name, at, len(raw), record_id, kind, url, digest, len(payload), target))
                at += len(raw)
            if rows:
                yield _batch(rows)
        if out is not None:
            out.close()

    index = _pages(pages, id_col, url_col, payload_col, least).mapInArrow(write, INDEX)
    index.write.parquet(f"{folder}/index")
    return index.sparkSession.read.schema(index.schema).parquet(f"{folder}/index")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [c.split() for c in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[t]) for v, (_, t) in zip(zip(*rows), fields)],
                                      names=[n for n, _ in fields])


def index_warc(spark: SparkSession, files: list[str] | DataFrame) -> DataFrame:
    """Index of archives from elsewhere (gzip member per record): one pass over each file, which
    holds one stretch of it at a time. ``files``: paths, or a table with a column ``file``."""
    if not isinstance(files, DataFrame):
        files = spark.createDataFrame([(f,) for f in files], "file string")

    def scan(batches):
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                with fsio.open_in(file) as f:
                    for offset, length, raw in _members(f):
                        r = parse_record(raw)
                        rows.append((file, offset, length, r["record_id"], r["record_type"], r["url"],
                                     r["digest"] or sha1_base32(r["payload"]), r["payload_bytes"],
                                     r["refers_to"]))
                        if len(rows) == common.BATCH_ROWS:
                            yield _batch(rows)
                            rows = []
                if rows:
                    yield _batch(rows)

    return files.select("file").repartition(common.parts(spark)).mapInArrow(scan, INDEX)


def _members(f, step: int = 1 << 20):
    """(offset, length, content) of each gzip member."""
    rest, at = f.read(step), 0
    while rest:
        press, out, used = zlib.decompressobj(31), [], 0
        while True:
            out.append(press.decompress(rest))
            used += len(rest) - len(press.unused_data)
            rest = press.unused_data
            if press.eof:
                break
            rest = f.read(step)
            if not rest:
                raise ValueError("the archive ends within a record")
        yield at, used, b"".join(out)
        at += used
        rest = rest or f.read(step)


def read_warc(index: DataFrame, gap: int = GAP, most: int = READ) -> DataFrame:
    """The records that ``index`` (all of it or a selection) points to, with payloads; a
    revisit has an empty one. Sorted ranges no more than ``gap`` apart are one read of up to
    ``most`` bytes. A response whose payload does not have the digest of its header fails."""
    def read(batches):
        for batch in batches:
            spans = zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length")))
            got = []
            for _, raw in fsio.ranged_reads(spans, gap, most):
                r = parse_record(zlib.decompress(raw, 31))
                if r["record_type"] == "response" and r["digest"] != sha1_base32(r["payload"]):
                    raise ValueError(f"digest of {r['record_id']} does not fit its payload")
                got.append(r)
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[c] for r in got], t) for c, t in RECORD.items()], names=list(RECORD))

    return (index.select("file", "offset", "length")
            .repartitionByRange(common.parts(index.sparkSession), "file", "offset")
            .sortWithinPartitions("file", "offset")
            .mapInArrow(read, "record_id string, record_type string, url string, refers_to string, "
                              "digest string, payload_bytes long, payload binary"))


RECORD = {"record_id": pa.string(), "record_type": pa.string(), "url": pa.string(),
          "refers_to": pa.string(), "digest": pa.string(), "payload_bytes": pa.int64(),
          "payload": pa.binary()}


def _page(column: str):
    """The id in a record name of ours; an empty one is NULL."""
    return F.nullif(F.substring_index(column, ":", -1), F.lit("")).cast("long")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_warc(common.table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_warc(index).select(
        _page("record_id").alias("page_id"), "payload_bytes", F.col("digest").alias("payload_digest"),
        "record_type", _page("refers_to").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS kept,
 list_transform(range(40), lambda i: strpos('0123456789abcdef', substr(h, i::INTEGER + 1, 1)) - 1) AS x
 FROM d)
SELECT page_id, n::BIGINT AS payload_bytes,
 list_aggregate(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + list_sum(list_transform(range(5), lambda t:
   ((x[(5 * j + t) // 4 + 1] >> (3 - (5 * j + t) % 4)::INTEGER) & 1) << (4 - t)::INTEGER))::INTEGER,
  1)), 'string_agg', '') AS payload_digest,
 CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM k
"""
