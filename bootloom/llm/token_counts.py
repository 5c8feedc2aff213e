"""Token counts, with huge documents encoded in overlapping chunks."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import bpe, common
from .textops import slices, text_bytes

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
CHUNK = 1 << 16     # characters of a huge document that are encoded at once
OVERLAP = 256       # characters two neighbouring chunks share at first


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


#: What a stable place follows: a printed ASCII character or a letter or digit, with white space behind it.
BEFORE_STABLE = re.compile(r"(?:[!-~]|[^\W_])(?=[ \t\n\r\x0b\x0c])")


def _stable(text: str, low: int, high: int) -> list[int]:
    """Places strictly between, last first, where no token can reach over: white space after
    a printed ASCII character or a letter or digit."""
    return [m.end() for m in BEFORE_STABLE.finditer(text, low, high)][::-1]


def _chunk_end(text: str, begin: int, chunk: int, overlap: int) -> int:
    """Where a chunk ends: just after the last stable place within its size, or the first one beyond where it
    has none, or at the end of the text. So no chunk is without a place to splice it at."""
    if begin + chunk >= len(text):
        return len(text)
    wide = overlap
    while True:
        low = max(begin, begin + chunk - wide)
        places = _stable(text, low, begin + chunk)
        if places or low == begin:
            break
        wide *= 2
    if places:
        place = places[0]
    else:
        found = BEFORE_STABLE.search(text, begin + chunk - 1)
        place = found.end() if found else len(text)
    return min(len(text), place + max(1, overlap // 2))


def chunked_ids(encoder: bpe.Encoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP):
    """Ids of one text from overlapping chunks.

    Two neighbours are spliced at a place in their overlap that is stable (see ``_stable``) and
    where both encodings begin a token. Should their overlap have none, the later chunk begins
    earlier and earlier, overlap by doubled overlap; in the end the two are one chunk. A stretch without any
    stable place (a script without spaces, say) is one chunk, however long, and encoded once.
    """
    def encode(a, b):
        e = encoder.tokenizer.encode(text[a:b], add_special_tokens=False)
        return np.array(e.ids, np.uint32), np.array([x[0] for x in e.offsets], np.int64) + a

    begin, end = 0, _chunk_end(text, 0, chunk, overlap)
    ids, at = encode(begin, end)
    done: list[np.ndarray] = []
    while end < len(text):
        stop, wide = _chunk_end(text, end, chunk, overlap), overlap
        while True:
            low = max(begin, end - wide)
            if low == begin:
                ids, at = encode(begin, stop)
                break
            new_ids, new_at = encode(low, stop)
            place = next((p for p in _stable(text, low, end)
                          if _begins(at, p) and _begins(new_at, p)), None)
            if place is not None:
                done.append(ids[:np.searchsorted(at, place)])
                keep = np.searchsorted(new_at, place)
                begin, ids, at = place, new_ids[keep:], new_at[keep:]
                break
            wide *= 2
        end = stop
    return np.concatenate([*done, ids])


def _begins(at: np.ndarray, place: int) -> bool:
    i = np.searchsorted(at, place)
    return i < len(at) and at[i] == place


def encode_batch(encoder: bpe.Encoder, data, offs, chunk: int = CHUNK, overlap: int = OVERLAP):
    """Ids of all texts and their numbers; those longer than ``chunk`` bytes go in chunks."""
    size = np.diff(offs)
    huge = np.flatnonzero(size > chunk) if encoder.byte_level else np.zeros(0, np.int64)
    if not len(huge):
        return encoder.encode(data, offs)
    parts, counts, begin = [], np.zeros(len(size), np.int64), 0
    for i in [*huge, len(size)]:
        if i > begin:
            ids, counts[begin:i] = encoder.encode(data[offs[begin]:offs[i]], offs[begin:i + 1] - offs[begin])
            parts.append(ids)
        if i < len(size):
            ids = chunked_ids(encoder, data[offs[i]:offs[i + 1]].tobytes().decode(), chunk, overlap)
            counts[i] = len(ids)
            parts.append(ids)
        begin = i + 1
    return np.concatenate(parts), counts


def token_counts(docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_col: str = "doc_id",
                 text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row per input row, without a shuffle.

    ``tokenizer`` is the path of a tokenizers ``.json`` or a sentencepiece ``.model`` file that
    every executor has. Byte-level files take huge documents in overlapping chunks; for others no
    place can be proven stable, so their texts are encoded whole. NULL and empty texts have no
    bytes and no tokens; NULL or repeated ids are passed on; other columns are left out.
    """
    df = common.pick(docs, doc_id=id_col, text=text_col)
    out = df.select("doc_id").schema.add("n_bytes", "long").add("n_tokens", "long").add(
        "over_limit", "boolean")

    def count(batches):
        if tokenizer.endswith(".model"):
            import sentencepiece
            piece = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
        else:
            encoder = bpe.load(tokenizer)
        for batch in slices(batches, "text", bpe.SLICE):
            data, offs = text_bytes(batch.column("text"))
            if tokenizer.endswith(".model"):
                texts = batch.column("text").fill_null("").to_pylist()
                n = np.array([len(x) for x in piece.encode(texts, num_threads=1)], np.int64)
            else:
                n = encode_batch(encoder, data, offs, chunk, overlap)[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(offs)), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return df.mapInArrow(count, out)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(common.table(spark, sf_dir, "documents"), tokenizer_path())
