"""Filter audit, hard negatives and word-table encoding against plain versions, on odd input, and on empty tables."""

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bootloom.llm import filter_audit, hard_negatives as hn, word_table
from bootloom.llm.token_counts import tokenizer_path

from . import brute

# ------------------------------------------------------------------ 11 filter audit


def plain_audit(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    flags = {}
    for i, q, t in labels:
        if i is not None:
            g, x = flags.get(i, (0, 0))
            flags[i] = (max(g, q == 1), max(x, t == 1))
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    parts = {}
    for i, t, source in rows:
        t = t or ""
        w = brute.words(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": i is not None and i > least[t]}
        parts.setdefault(source or "", []).append(({f for f in fails if fails[f]}, *flags.get(i, (0, 0))))
    out = {}
    for part, docs in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(gone)
                failing = sum(f in d[0] for d in docs)
                out[part, "".join(order), k] = [f, len(left), len(gone), failing - len(gone), sum(
                    d[0] == {f} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[out[key][0]])
    return {k: tuple(int(x) for x in v[1:]) for k, v in out.items()}


def long_texts(rng):
    common = [f"w{i}" for i in range(400)]
    for i in range(60):
        w = rng.sample(common, rng.randrange(150, 320))
        if i % 3 == 0:
            w = w[:80] * 4
        if i % 4 == 0:
            w = [x.upper() for x in w[:30]] + w[30:]
        if i % 5 == 0:
            w[3] = "a|b"
        yield " ".join(w)


def audited(df):
    return {(r["part"], r["filter_order"], r["step"]): (
        r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"])
        for r in df.collect()}


@pytest.fixture(scope="module")
def audit_rows(texts):
    rng = random.Random(3)
    every = texts + list(long_texts(rng)) * 2
    rng.shuffle(every)
    return [(i, t, [None, "", "s", "other"][i % 4]) for i, t in enumerate(every)]


LABELS = [(i, i % 3 % 2, i % 2) for i in range(0, 300, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (6, None, None),
                                                              (10 ** 9, 1, 1)]


def test_audit(spark, audit_rows):
    docs = spark.createDataFrame(audit_rows, "doc_id long, text string, source string").withColumns(
        {"part": F.lit(1), "mask": F.lit("x"), "digest": F.lit(2), "good": F.lit(3)})
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").withColumn("text", F.lit("t"))
    got = audited(filter_audit.audit(docs.repartition(7), labels))
    assert len(got) == 3 * 600 and got == plain_audit(audit_rows, LABELS)
    assert any(v[3] for v in got.values()) and any(v[4] for v in got.values()) and any(v[5] for v in got.values())


def test_audit_takes_null_and_repeated_ids_and_rows(spark, audit_rows):
    rows = [([None, 7, 7, i][i % 4], t, s) for i, t, s in audit_rows] + [(7, "same", "s")] * 30 + [(3, "same", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audited(filter_audit.audit(docs, labels)) == plain_audit(rows, LABELS)


def test_audit_of_nothing(spark, docs, none):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(none, labels).count() == 0
    got = audited(filter_audit.audit(docs, labels.where("false")))
    assert got and not any(v[4] or v[5] for v in got.values())


@pytest.mark.parametrize("n", [1, 3, 6])
def test_gray_walk_of_any_number_of_filters(n):
    rng = np.random.default_rng(n)
    masks = np.arange(1 << n)[rng.random(1 << n) < 0.7]
    counts = rng.integers(0, 50, (len(masks), 3))
    states = filter_audit.gray_states(masks, counts, n)
    for subset in range(1 << n):
        assert (states[subset] == counts[masks & subset == 0].sum(axis=0)).all()


def test_a_common_text_needs_no_join(spark, docs):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    plan = filter_audit.failure_cells(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


# ------------------------------------------------------------------ 12 hard negatives

def plain_negatives(rows):
    """rows: (id, label, vector) as given; ids are unique."""
    seen = set()
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        seen.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    out = set()
    for a, own, q in seen:
        if a % 100:
            continue
        every = sorted((-sum(x * y for x, y in zip(q, v)), i, label) for i, label, v in seen if i != a)
        for s, p, label in [e for e in every if e[2] == own][:5]:
            hits = [e for e in every if e[2] != own and 80 * -s <= 100 * -e[0] <= 100 * -s][:5]
            out |= {(a, p, k, e[1], -s, -e[0]) for k, e in enumerate(hits, 1)}
    return out


def mined(spark, rows, files=6):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns(
        {"id": F.lit(1), "vector": F.lit("x"), "cell": F.lit(2), "aid": F.lit(3), "low": F.lit(4)})
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hn.hard_negatives(df.repartition(files), F.col("id") % 100 == 0, label)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


def vectors(seed, n=900, d=8, groups=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 0.4, (groups, d))
    v = middle[rng.integers(0, groups, n)] + rng.normal(0, 0.05, (n, d))
    v[n // 3:n // 2] = v[n // 3]                     # copies, with ties between labels
    v[-20:] *= 0
    return [(i, int(rng.integers(0, 10)), [float(x) for x in row]) for i, row in enumerate(v)]


@pytest.mark.parametrize("seed", [0, 1])
def test_negatives_in_many_trees(spark, monkeypatch, seed):
    monkeypatch.setattr(hn, "TREE_ROWS", 60)
    monkeypatch.setattr(hn, "CENTRES", 7)
    rows = vectors(seed)
    assert mined(spark, rows) == plain_negatives(rows) != set()


def test_negatives_of_odd_rows(spark):
    rows = vectors(5, 320, 6)
    rows += rows[:40]                                # equal rows are one
    rows += [(None, 1, [1.0] * 6), (1000, None, [1.0] * 6), (1001, 1, None), (1002, 1, [1.0, None]),
             (1003, 1, [math.nan] * 6), (1004, 1, [math.inf] * 6), (1100, 3, [0.5, 0.5]), (1101, 3, []),
             (1102, 3, [0.5, 0.5, 0.1]), (1200, 55, [0.2] * 6), (1300, 4, [])]
    assert mined(spark, rows) == plain_negatives(rows)


def test_negatives_of_large_components(spark):
    rows = [(i, label, [x * 1e6 for x in v]) for i, label, v in vectors(2, 220, 5)]
    rows += [(500 + i, 1, [2.0 ** 21 * i, 3.0]) for i in range(5)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hn.hard_negatives(df, F.col("id") % 100 == 0, F.col("label")).count() == 0
    one = [(1, 1, [0.5]), (100, 1, [0.5])]
    assert mined(spark, one) == set()


def test_trees_cover_and_skip():
    rng = np.random.default_rng(0)
    x = (rng.normal(0, 200, (30, 6))[rng.integers(0, 30, 2000)] + rng.normal(0, 4, (2000, 6))).astype(np.int64)
    m2 = float(np.square(x.astype(float)).sum(axis=1).max()) * 1.5
    tree = hn.Tree(x, np.zeros(2000, np.int64), [[i] for i in range(2000)], m2)
    assert sorted(i for k in tree.ids for i in k) == list(range(2000))
    for i in range(len(tree.centre)):
        a, b = tree.begin[i], tree.end[i]
        d = hn._distances(tree.vectors[a:b], tree.centres[i:i + 1], m2)
        assert (d <= tree.radius[i]).all() and (d >= tree.inner[i]).all()
        kids = range(tree.first[i], tree.last[i])
        if kids:
            assert sorted((tree.begin[k], tree.end[k]) for k in kids)[0][0] == a
            assert sum(tree.end[k] - tree.begin[k] for k in kids) == b - a
    q = x[:40]
    low, high = hn.bounds(q, tree.centres, tree.radius, tree.inner, m2)
    every = hn.products(q, tree.vectors)
    for i in range(len(tree.centre)):
        own = every[:, tree.begin[i]:tree.end[i]]
        assert (own.min(axis=1) >= low[:, i]).all() and (own.max(axis=1) <= high[:, i]).all()
    looked = []

    def wanted(labels):
        looked.append(len(labels))
        return labels == 0

    best = tree.descend(q[0], low[0], high[0], [(-math.inf, math.inf)], wanted)[0]
    assert best == sorted((-int(s), tree.ids[i][0]) for i, s in enumerate(every[0]))[:5]
    assert sum(looked) < 1000                        # most rows lie outside of the bounds


# ------------------------------------------------------------------ 13 word table

@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer_path())
    t.no_truncation()
    t.no_padding()
    return t


def plain_digests(t, text):
    ids = t.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            brute.sha(t.decode(ids, skip_special_tokens=False)))


COLUMNS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
ODD = ["a b   c　d", "<|endoftext|>", "x<|endoftext|> <|endoftext|>y", "  lead", "trail  ", "\n\n a\n\n\nb \t c",
       "it's we'll I'M don't", "汉字 没有 空格" * 300, "\x00 \x1c\x85 ​ ﻿", "👩‍👩‍👧 é é \U0010ffff", "1 22 333 4444 55555",
       "\r\n" * 50, " " * 100, "�  � x", "a" * 5000 + " b"]


@pytest.mark.parametrize("size", [1 << 24, 3000, 1])
def test_words_round_trip(spark, library, texts, size):
    every = texts + ODD
    df = spark.createDataFrame(list(enumerate(every)), "doc_id long, text string").withColumns(
        {c: F.lit(1) for c in ("slice", "ids", "word", "code", "counts", "words", "token")}).repartition(4)
    got = {r["doc_id"]: tuple(r)[1:] for r in word_table.encode_and_decode(
        df, tokenizer_path(), word_table.digests, COLUMNS, slice_bytes=size).collect()}
    assert got == {i: plain_digests(library, t) for i, t in enumerate(every)}


def test_words_of_odd_rows(spark, library, messy, none):
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), *tuple(r)[1:]) for r in word_table.encode_and_decode(
        messy, tokenizer_path(), word_table.digests, COLUMNS).collect())
    assert got == sorted(((r["doc_id"] is not None, r["doc_id"] or 0), *plain_digests(library, r["text"]))
                         for r in messy.collect())
    assert word_table.encode_and_decode(none, tokenizer_path(), word_table.digests, COLUMNS).count() == 0


def test_each_distinct_word_meets_in_one_bucket(spark, docs):
    coded = word_table.coded_slices(docs, "doc_id", "text", 3000, 5)
    lists = coded.select("slice", F.explode("lists").alias("l")).select("slice", "l.*")
    words = set()
    for r in docs.collect():
        data = np.frombuffer((r["text"] or "").encode(), np.uint8)
        start, length, _ = word_table.word_spans(data, np.array([0, len(data)]))
        words |= {data[s:s + n].tobytes() for s, n in zip(start, length)}
    pieces = word_table.piece_table(spark, tokenizer_path())
    answers = word_table.answered_lists(lists.repartition(3, "bucket"), tokenizer_path(), pieces).collect()
    listed = lists.collect()
    assert len(answers) == len(listed) and sum(r["n"] for r in answers) == sum(r["size"] for r in listed) > len(words)
    assert not any(r["n_other"] for r in answers)
    buckets = {}
    for r in listed:
        own = word_table._cut(word_table._expanded(bytes(r["words"]), r["length"]), np.cumsum(
            word_table._restored(bytes(r["lengths"]), r["size"])))
        buckets.setdefault(r["bucket"], set()).update(own)
    assert sum(map(len, buckets.values())) == len(words) == len(set().union(*buckets.values()))


def test_decoded_bytes_come_from_the_pieces(spark, docs, monkeypatch):
    """With other pieces the texts decode to other bytes."""
    keep = word_table.piece_table
    monkeypatch.setattr(word_table, "piece_table", lambda s, path: keep(s, path).withColumn(
        "piece", F.when(F.col("token") % 3 == 0, F.concat("piece", F.lit(b"!?"))).otherwise(F.col("piece"))))
    pieces = {r["token"]: bytes(r["piece"]) for r in word_table.piece_table(spark, tokenizer_path()).collect()}
    out = word_table.encode_and_decode(docs, tokenizer_path(), lambda ids, text: (ids, text), "ids binary, text binary")
    for r in out.collect():
        assert bytes(r["text"]) == b"".join(pieces[i] for i in np.frombuffer(bytes(r["ids"]), "<u4").tolist())


def test_numbers_and_bytes_are_restored():
    rng = np.random.default_rng(1)
    for top, n in ((1, 5), (300, 1000), (1 << 17, 1000), (5, 0)):
        x = rng.integers(0, top, n)
        assert (word_table._restored(word_table._shrunk(x), n) == x).all()
    assert word_table._expanded(word_table._squeezed(b"ab" * 99), 198) == b"ab" * 99
    assert word_table._expanded(word_table._squeezed(b""), 0) == b""


def test_words_of_one_hash_are_told_apart(monkeypatch):
    data = np.frombuffer(b"a b a c b a", np.uint8)
    start, length, _ = word_table.word_spans(data, np.array([0, len(data)]))
    monkeypatch.setattr(word_table, "hash_spans", lambda d, s, n, which=0: np.arange(len(s)).astype(np.uint64) * np.uint64(which))
    words, bucket, codes = word_table.distinct_words(data, start, length, 3)
    assert [words[c] for c in codes] == [b"a", b" b", b" a", b" c", b" b", b" a"] and len(words) == 4


def test_other_vocabularies_are_refused(spark, docs):
    with pytest.raises(ValueError):
        word_table.encode_and_decode(docs, tokenizer_path("word_bpe_49k.json"), word_table.digests, COLUMNS)
