"""Each corpus operator against a plain version, on odd input, and on empty tables."""

import glob
import os
import random
import time
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as e
from bootloom.llm import (bpe, common, components, decontaminate, fsio, mixing, ngram_join, pii, quality,
                          substring_dedup, token_counts, token_store, toxicity, warc)
from bootloom.llm.textops import find_words, hash_spans, slices, text_bytes
from tools.compare import differences

from . import brute

TOKENIZER = token_counts.tokenizer_path()


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.orderBy("doc_id").collect()]


# ------------------------------------------------------------------ SQL twins, whole tables

@pytest.mark.parametrize("key", sorted(e.CORPUS_ORACLES))
def test_query_equals_its_twin(spark, sf_dir, key):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    assert differences(e.queries()[key](spark, sf_dir).toPandas(), con.execute(e.CORPUS_ORACLES[key]).df()) == ""


def test_every_operator_is_registered():
    names = sorted(e.CORPUS_QUERIES)
    assert "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


# ------------------------------------------------------------------ helpers

def test_keyed_numbers_odd_ids_in_order(messy, docs, none):
    same = common.keyed(docs).collect()
    assert all(r["uid"] == r["id"] for r in same)
    rows = sorted(common.keyed(messy, whole=True).collect(), key=lambda r: r["uid"])
    assert len(rows) == messy.count() == len({r["uid"] for r in rows})
    ids = [r["id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    assert rows[0]["row"].asDict().keys() == set(messy.columns)
    assert common.keyed(none).count() == 0


def test_words_of_batches(texts):
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    seen = []
    for part in slices([batch.slice(3), batch.slice(0, 3)], "text", 500):
        data, offs = text_bytes(part.column("text"))
        w = find_words(data, offs)
        h = hash_spans(data, w.start, w.length)
        for i in range(part.num_rows):
            a, b = w.first[i], w.first[i + 1]
            seen.append([data[s:s + n].tobytes().decode() for s, n in zip(w.start[a:b], w.length[a:b])])
            assert len(set(h[a:b].tolist())) == len(set(seen[-1]))
    assert seen == [brute.words(t) for t in texts[3:] + texts[:3]]


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 60)] + [
        (rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(5, 5), (1, 0)]
    root = {i: i for i in range(400)}
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components.components(
        spark.createDataFrame(links, "a long, b long").repartition(7)).collect()}
    assert got == {i: r for i, r in root.items() if r != i}


# ------------------------------------------------------------------ 1 WARC

def pages(spark):
    rows = [(1, "http://a/\r\nx: y", "same"), (2, None, "same"), (9, "u", "same"), (3, "u", None), (4, "u", ""),
            (5, "u", "é" * 70_000), (6, "u", "\r\n\r\nHTTP/1.1 200"), (None, "u", "same"), (None, "v", "alone"), (9, "u", "same")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", common.F.lit(1))


def test_warc_round_trip(spark, tmp_path):
    df = pages(spark)
    index = warc.write_warc(df, f"{tmp_path}/w", file_bytes=2000)
    got = [r.asDict() for r in warc.read_warc(index).collect()]
    assert len(got) == df.count()
    kept = {r["record_id"]: r["payload"].decode() for r in got if r["record_type"] == "response"}
    assert kept["urn:page:5"] == "é" * 70_000 and kept["urn:page:6"] == "\r\n\r\nHTTP/1.1 200"
    assert kept["urn:page:9"] == "same" and kept["urn:page:4"] == "" and kept["urn:page:"] == "alone"
    revisits = sorted((r["record_id"], r["refers_to"], r["payload_bytes"]) for r in got if r["record_type"] == "revisit")
    assert revisits == [("urn:page:", "urn:page:9", 4), ("urn:page:1", "urn:page:9", 4), ("urn:page:2", "urn:page:9", 4),
                        ("urn:page:3", "urn:page:4", 0)]
    assert all(r["digest"] == warc.sha1_base32(kept[r["refers_to"] or r["record_id"]].encode())
               for r in got if r["record_id"] != "urn:page:")


def test_warc_index_of_plain_archives_and_selection(spark, tmp_path):
    index = warc.write_warc(pages(spark), f"{tmp_path}/w")
    files = [r[0] for r in index.select("file").distinct().collect()]
    again = warc.index_warc(spark, files)
    columns = ["file", "offset", "length", "record_id", "digest", "payload_bytes", "refers_to"]
    rows = lambda df: sorted(map(str, df.select(columns).collect()))
    assert rows(again) == rows(index)
    some = warc.read_warc(index.where("record_id = 'urn:page:5'"), gap=0, most=10).collect()
    assert [r["payload_bytes"] for r in some] == [140_000]


def test_warc_small_payloads_and_empty(spark, tmp_path):
    index = warc.write_warc(pages(spark), f"{tmp_path}/a", least=5)
    assert {r["record_type"] for r in index.collect()} == {"response"}
    assert warc.read_warc(warc.write_warc(pages(spark).where("false"), f"{tmp_path}/b")).count() == 0


def test_ranged_reads_join_neighbours(tmp_path):
    data = os.urandom(5000)
    for name in "ab":
        (tmp_path / name).write_bytes(data)
    spans = [(f"{tmp_path}/{f}", o, n) for f in "ab" for o, n in ((0, 10), (10, 0), (10, 90), (2000, 1000), (3000, 2000))]
    got = dict(fsio.ranged_reads(spans, gap=100, most=1500))
    assert [got[i] for i in range(len(spans))] == [data[o:o + n] for _, o, n in spans]


# ------------------------------------------------------------------ 2 and 10: tokens

def test_store_equals_tokenizer(docs):
    ids = [x + [0] for x in bpe.load(TOKENIZER).whole([t or "" for _, t in pairs(docs)])]
    got = sorted(token_store.stored_digests(docs, TOKENIZER).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [i for i, _ in pairs(docs)]
    assert [r["n_tokens"] for r in got] == [len(x) for x in ids]
    assert [r["start"] for r in got] == np.cumsum([0] + [len(x) for x in ids])[:-1].tolist()
    assert [r["ids_crc32"] for r in got] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]


def test_store_with_repeated_and_no_ids(messy, none, tmp_path):
    got = token_store.stored_digests(messy, TOKENIZER).collect()
    rows = messy.collect()
    assert len(got) == len(rows)
    ids = bpe.load(TOKENIZER).whole([r["text"] or "" for r in rows])
    expected = sorted((str(r["doc_id"]), zlib.crc32(np.array(x + [0], "<u4").tobytes())) for r, x in zip(rows, ids))
    assert sorted((str(r["doc_id"]), r["ids_crc32"]) for r in got) == expected
    store = token_store.write_store(messy, f"{tmp_path}/s", TOKENIZER)
    assert store.get(7) is not None and store.get(None) is not None and store.get("no such key") is None
    assert token_store.stored_digests(none, TOKENIZER).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 500, 5000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    low = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
    low[: n // 100] = low[n - n // 100:]  # equal hashes of different keys
    slots = np.zeros(n, token_store.SLOT)
    slots["fingerprint"] = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
    slots["offset"] = np.arange(n)
    once = np.array([i for i in range(n) if (low == low[i]).sum() == 1], int)
    found, got = token_store.find_in_bucket(token_store.pack_bucket(low, slots), slots["fingerprint"][once], low[once])
    assert found.all() and (got["offset"] == once).all()
    other = rng.integers(0, 2 ** 63, 1000, dtype=np.uint64)
    assert not token_store.find_in_bucket(token_store.pack_bucket(low, slots), other, other)[0].any()


def test_token_counts(docs, messy, none, texts):
    ids = dict(zip([i for i, _ in pairs(docs)], bpe.load(TOKENIZER).whole([t or "" for _, t in pairs(docs)])))
    for options in ({}, {"chunk": 64, "overlap": 4}):
        got = by_id(token_counts.token_counts(docs, TOKENIZER, **options))
        assert {i: r["n_tokens"] for i, r in got.items()} == {i: len(x) for i, x in ids.items()}
    assert all(r["n_bytes"] == len((t or "").encode()) and r["over_limit"] == (r["n_tokens"] > 512)
               for (i, t) in pairs(docs) for r in [got[i]])
    assert token_counts.token_counts(messy, TOKENIZER).count() == messy.count()
    assert token_counts.token_counts(none, TOKENIZER).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_of_other_libraries(docs, name):
    path = token_counts.tokenizer_path(name)
    rows = [(i, t or "") for i, t in pairs(docs) if len(t or "") < 2000]
    if name.endswith("json"):
        n = [len(x) for x in bpe.Encoder(path).whole([t for _, t in rows])]
    else:
        import sentencepiece
        n = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=path).encode([t for _, t in rows])]
    got = by_id(token_counts.token_counts(docs, path))
    assert [got[i]["n_tokens"] for i, _ in rows] == n


@pytest.mark.parametrize("text", ["x" * 3000 + " y" * 50, "ab " * 2000, "é" * 999 + " " * 500 + "ü" * 700,
                                  "<|endoftext|>" * 300, "a<|endoftext|> b" * 99, "\n 　 \x1c a" * 300, ""])
def test_chunks_are_spliced_exactly(text):
    encoder = bpe.load(TOKENIZER)
    for chunk, overlap in ((100, 8), (7, 3), (1000, 1)):
        assert token_counts.chunked_ids(encoder, text, chunk, overlap).tolist() == encoder.whole([text])[0]


def test_texts_without_spaces_are_encoded_once():
    encoder = bpe.load(TOKENIZER)
    rng = random.Random(8)
    text = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(1_000_000))
    seen, encode = [], encoder.tokenizer.encode

    class Spy:
        def encode(self, part, **options):
            seen.append(len(part))
            return encode(part, **options)

    spy = type("Encoder", (), {"tokenizer": Spy()})()
    for extra, most in (("", 1.0), (" some words between " * 9000 + text[:300_000], 1.02)):
        whole = text + extra
        seen.clear()
        assert token_counts.chunked_ids(spy, whole).tolist() == encoder.whole([whole])[0]
        assert sum(seen) <= most * len(whole)


# ------------------------------------------------------------------ 3 mixing

def test_mixing(docs, messy, none):
    rows = mixing.mix(docs).collect()
    text = dict(pairs(docs))
    assert all(r["size"] == len(brute.words(text[r["doc_id"]])) for r in rows)
    source = {r["doc_id"]: r["source"] for r in docs.collect()}
    sizes = {}
    for r in rows:
        sizes[source[r["doc_id"]]] = sizes.get(source[r["doc_id"]], 0) + r["size"]
    weight = dict(zip(["S1", "s1", "s2", None], (5, 2, 1, 5)))
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(sizes)
    while open_:
        over = [s for s in open_ if left * weight[s] / sum(weight[x] for x in open_) > 2 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    for s in sizes:
        own = [r for r in rows if source[r["doc_id"]] == s]
        assert all(abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == sizes[s] for r in own)
        assert abs(sum(r["taken"] for r in own) - target[s]) <= max(r["size"] for r in own) / 2 + 1e-9
        assert len({r["epochs"] for r in own}) <= 2 and all(0 <= r["taken"] <= 2 * r["size"] for r in own)
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(rows) == sorted(again)
    assert mixing.mix(messy).count() == messy.count() and mixing.mix(none).count() == 0


# ------------------------------------------------------------------ 4 quality

def test_statistics_and_base_rules(docs):
    got = by_id(quality.judge(quality.statistics(docs)))
    for i, t in pairs(docs):
        w = brute.words(t)
        three = [tuple(w[j:j + 3]) for j in range(len(w) - 2)]
        twice = {x for x in three if three.count(x) > 1} if len(w) < 2000 else set()
        covered = {j + k for j, x in enumerate(three) if x in twice for k in range(3)}
        lines = [x for x in (t or "").split("\n") if brute.words(x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)))
        assert r["n_symbols"] == sum((t or "").count(c) for c in "#*$%&|<>")
        if len(w) < 2000:
            assert r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(w) < 50 or 100 * r["n_repeat_words"] > 50 * len(w))
        assert not (r["base_failed"] and r["kept"])


def test_outliers_are_rejected_and_others_stay(spark, none):
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 10)))
    rows = []
    for i in range(900):
        w = [word() for _ in range(rng.randrange(60, 600))]
        if i % 9 == 4:
            w = [x + "$$$" for x in w]
        rows.append((i, " ".join(w), ["en", None][i % 2], "s" if i % 3 else None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = by_id(quality.judge(quality.statistics(df)))
    assert all(r["kept"] == (i % 9 != 4) for i, r in got.items())
    assert quality.judge(quality.statistics(none)).count() == 0


def test_scatter_is_estimated_or_that_of_counting(spark):
    """Texts of one language without symbols and repeats, of another in which symbols vary much."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 10)))

    def text(symbols, repeated=0):
        lines = [[word() for _ in range(12)] for _ in range(40)]
        for line in lines[40 - repeated:]:
            line[:9] = lines[0][:9]
        w = [x for line in lines for x in line]
        for i in rng.sample(range(len(w)), round(symbols * sum(map(len, w)))):
            w[i] = "$" + w[i][1:]
        return "\n".join(" ".join(w[i:i + 12]) for i in range(0, len(w), 12))

    plain = [text(0) for _ in range(300)] + [text(0.05), text(0, 20)]
    varied = [text(rng.uniform(0, 0.12)) for _ in range(300)] + [text(0.05)]
    df = spark.createDataFrame([(i, t, "plain" if i < 302 else "varied", "s") for i, t in enumerate(plain + varied)],
                               "doc_id long, text string, lang string, source string")
    got = by_id(quality.judge(quality.statistics(df)))
    assert not any(r["base_failed"] for r in got.values())
    assert [i for i, r in got.items() if not r["kept"]] == [300, 301]


def test_estimates_do_not_jump_with_the_size_of_a_source(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randrange(2, 10)))
    text = lambda low, high: " ".join(word() for _ in range(rng.randrange(low, high)))
    short, long = [text(60, 90) for _ in range(200)], [text(300, 900) for _ in range(190)]
    schema = "doc_id long, text string, lang string, source string"
    found = []
    for n in (199, 201):
        rows = [(0, text(200, 201), "en", "a")] if not found else rows[:1]  # noqa: F821
        rows += [(1 + i, t, "en", "a") for i, t in enumerate(short[:n - 1])]
        rows += [(1000 + i, t, "en", "b") for i, t in enumerate(long)]
        found.append(by_id(quality.judge(quality.statistics(spark.createDataFrame(rows, schema))))[0]["distance"])
    assert abs(found[0] - found[1]) < 0.1 * found[0]


def test_few_texts_have_estimates_too(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 10))) + "$$$" * (i == 4) for _ in range(
        rng.randrange(200, 400))), ["en", None][i % 2], f"s{i % 5}") for i in range(25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [i for i, r in by_id(quality.judge(quality.statistics(df))).items() if not r["kept"]] == [4]
    assert all(r["kept"] for r in quality.judge(quality.statistics(df.where("doc_id < 5"))).collect())


def test_cut_of_few_texts():
    for d in (1.0, 30.0):
        b = d * 7 / 48 / (1 + d * 7 / 48)
        assert abs(quality._beyond(d, 7) - (1 - b ** 2.5)) < 1e-9
    cuts = [quality._cut(n) for n in (5, 10, 100, 10_000, 10 ** 6, 10 ** 9)]
    assert cuts == sorted(cuts, reverse=True) and abs(cuts[-2] - cuts[-1]) < 0.01 and abs(cuts[-1] - 35.888) < 1e-3


def test_chi_square():
    assert abs(quality._chi2(4.351460, 5) - 0.5) < 1e-6 and abs(quality._chi2(9.236357, 5) - 0.9) < 1e-6


# ------------------------------------------------------------------ 5 personal data

def test_base_spans_and_added_ones(spark, docs, messy, none):
    odd = ["a@b.cd+e@f.gh x@y z@q.w.e..r", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.0003.255", "5 - 4111111111111111",
           "12-4111 1111 1111 1111 9 4 4111111111111111", "@@a@b.c@d.e", "+1+1234567890 +49 30 1234567 (", "é +1 (555) 123-4567",
           "contact: joe [at] mail (dot) com tel (555) 123-4567", "4111-1111-1111-1111,41111111111111112"]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(-1 - i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    got = by_id(pii.find_pii(df))
    for i, t in pairs(df):
        spans = brute.base_spans(t)
        assert got[i]["base_sha256"] == brute.sha(brute.span_text(spans)), t[:80]
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == j for x in spans) for j in range(4)]
        assert set(filter(None, brute.span_text(spans).split(","))) <= set(got[i]["spans"].split(","))
    assert got[-8]["spans"] == "email:9:32,phone:37:51"
    assert pii.find_pii(messy).count() == messy.count() and pii.find_pii(none).count() == 0


def test_no_python_on_the_main_path(docs):
    plan = pii.spans(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ 6 n-gram join

@pytest.mark.parametrize("size,percent", [(3, 90), (5, 80), (1, 50)])
def test_near_duplicates(docs, none, size, percent):
    rows = pairs(docs)
    expected = brute.near_components([t for _, t in rows], size, percent)
    got = by_id(ngram_join.near_duplicates(docs, size, percent))
    for (i, _), (n, root) in zip(rows, expected):
        assert (got[i]["n_shingles"], got[i]["component_id"]) == (n, rows[root][0])
    assert ngram_join.near_duplicates(none, size, percent).count() == 0


def test_near_duplicates_with_odd_ids(messy):
    got = ngram_join.near_duplicates(messy, 3, 90).collect()
    assert len(got) == messy.count() == len({r["uid"] for r in got})
    keyed = sorted(common.keyed(messy).collect(), key=lambda r: r["uid"])
    expected = brute.near_components([r["text"] for r in keyed], 3, 90)
    groups = lambda roots: sorted(np.unique(roots, return_counts=True)[1].tolist())
    assert groups([r["first_uid"] for r in got]) == groups([r for _, r in expected])


def test_chains_and_hubs_of_near_copies(spark):
    rng = random.Random(5)
    rows = []
    for g in range(4):
        base = [f"g{g}w{i}" for i in range(60)]
        chain = list(base)
        for i in range(30):
            chain = chain[1:] + [f"c{g}x{i}"]
            far = list(base)
            for _ in range(1 + i % 3):
                far[rng.randrange(60)] = f"f{rng.randrange(10 ** 6)}"
            rows += [chain, far]
    texts = [" ".join(x) for x in rows]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = by_id(ngram_join.near_duplicates(df, 3, 90))
    assert [got[i]["component_id"] for i in range(len(texts))] == [r for _, r in brute.near_components(texts, 3, 90)]


# ------------------------------------------------------------------ 7 toxicity

def all_maximal(scores):
    """By the definition: the best segment, then the same left and right of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
               default=(0,))
    if best[0] <= 0:
        return []
    a, b = best[3], best[4]
    return all_maximal(scores[:a]) + [(a, b)] + [(x + b, y + b) for x, y in all_maximal(scores[b:])]


def test_maximal_segments():
    rng = random.Random(2)
    for _ in range(200):
        scores = [rng.choice([-1.0, -1.5, 2.25, 3.5, -4.125]) + rng.random() / 1000 for _ in range(rng.randrange(1, 25))]
        hits = [i for i, s in enumerate(scores) if s > 0]
        sums = np.cumsum(scores)
        got = toxicity.maximal_segments([sums[i] - scores[i] for i in hits], [sums[i] for i in hits])
        assert sorted((hits[a], hits[b] + 1) for _, a, b in got) == all_maximal(scores)


def toxic_table(spark, n=600):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 200))]
        bad = i % 7 == 0
        for _ in range(3 if bad else 0):
            w[rng.randrange(len(w))] = rng.choice(["Vile", "rotten", "foul"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    labels += [(None, 1), (3, None), (10 ** 9, 1)]
    return (spark.createDataFrame([*rows, (n, None), (n + 1, "")], "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_toxic_texts_are_found_in_rows_left_out(spark, none):
    df, labels = toxic_table(spark)
    model = toxicity.fit(df, labels, rows=~toxicity.held_out())
    got = by_id(toxicity.score(df, model, spans=True))
    out = [r["doc_id"] for r in df.where(toxicity.held_out()).collect() if r["doc_id"] < 600]
    right = sum(got[i]["predicted"] == (i % 7 == 0) for i in out)
    assert len(out) > 60 and right / len(out) > 0.97
    text = {r["doc_id"]: r["text"] for r in df.collect()}
    for i in out:
        for p in got[i]["passages"]:
            w = brute.words(brute.lower(text[i]))
            assert w[p["first"]] in ("vile", "rotten", "foul") and w[p["last"]] in ("vile", "rotten", "foul")
    assert all(0 <= r["score"] <= 1 and (r["score"] >= 0.5) == r["predicted"] for r in got.values())
    assert got[600]["score"] == got[601]["score"] < 0.5
    kept = {r["doc_id"] for r in df.where(~toxicity.is_toxic(model, common.F.col("text"))).collect()}
    assert kept == {i for i, r in got.items() if not r["predicted"]}
    assert toxicity.score(none, model).count() == 0


def test_scores_by_brute_force(spark):
    """Counts, log-odds of all tokens, segments, evidence and score, spelled out."""
    df, labels = toxic_table(spark, 150)
    model = toxicity.fit(df, labels, rows=~toxicity.held_out())
    y = {r["doc_id"]: r["toxic"] for r in labels.collect() if r["doc_id"] is not None and r["toxic"] is not None}
    texts = {r["doc_id"]: brute.ALNUM.findall(brute.lower(r["text"])) for r in df.collect()}
    fitted = [i for i in texts if i in y and zlib.crc32(str(i).encode()) % 5]
    counts = {}
    for i in fitted:
        for w in set(texts[i]):
            counts.setdefault(w, [0, 0])[1 - y[i]] += 1
    assert len(model.tokens) == len(counts)
    rate = sum(c[0] for c in counts.values()) / sum(map(sum, counts.values()))
    m = toxicity.PRIOR

    def odds(w, minus=(0, 0)):
        a, b = (max(c - x, 0) for c, x in zip(counts.get(w, (0, 0)), minus))
        return np.log((a + m * rate) / (b + m * (1 - rate))) - np.log(rate / (1 - rate))

    assert odds("vile") > 1 and min(odds(w) for w in counts) < -0.2 and odds("never seen") == pytest.approx(0)

    def raw(words, minus=(0, 0)):
        scores = [odds(w, minus) - toxicity.DRIFT for w in words]
        found = [(sum(scores[a:b])) for a, b in all_maximal(scores)]
        if not found:
            return 0.0, 0.0, 0.0, 0.0
        e = [model.decay * s - np.log(model.scale * max(len(words), 1)) for s in found]
        return max(-20.0, min(50.0, max(e))), np.log1p(sum(max(0.0, x) for x in e)), 1.0, max(found)

    null = [(raw(texts[i], (0, 1))[3], len(texts[i])) for i in fitted if not y[i]]
    assert model.scale == pytest.approx(np.exp(np.mean([model.decay * s - np.log(max(n, 1)) for s, n in null]) - toxicity.EULER))
    clean = sum(c[1] for c in counts.values())
    assert sum(c[1] / clean * np.exp(model.decay * (odds(w) - toxicity.DRIFT)) for w, c in counts.items()) == pytest.approx(1)
    x = np.array([raw(texts[i], (y[i], 1 - y[i]))[:3] for i in fitted])
    assert model.curve == pytest.approx(toxicity._logistic(x, np.array([float(y[i]) for i in fitted])), rel=1e-6)
    for r in toxicity.score(df, model).collect():
        z = model.curve @ np.array([1.0, *raw(texts[r["doc_id"]])[:3]])
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), rel=1e-9)


def test_segments_are_found_in_linear_time():
    for gap in (-5.0, -0.5, -0.999999):
        scores = np.tile([1.0, gap], 100_000)
        total = np.cumsum(scores)
        began = time.perf_counter()
        toxicity.maximal_segments((total - scores)[::2].tolist(), total[::2].tolist())
        assert time.perf_counter() - began < 1


def test_repeated_ids_labels_and_empty_tables(spark, messy, none):
    labels = spark.createDataFrame([(7, 0), (7, 1), (7, None), (None, 1), (3, 0), (5, 0), (9, 0)], "doc_id long, toxic int")
    model = toxicity.fit(messy, labels)
    n = messy.where("doc_id = 7").count()
    assert int(model.toxic.max()) <= n and len(model.tokens)
    assert toxicity.score(messy, model).count() == messy.count()
    verdicts = messy.where(toxicity.is_toxic(model, common.F.col("text"))).count()
    assert verdicts == toxicity.score(messy, model).where("predicted = 1").count()
    assert none.where(toxicity.is_toxic(model, common.F.col("text"))).count() == 0


def test_the_sample_shrinks_to_a_model_of_bounded_size(spark, monkeypatch):
    rows = [(i, f"own{i} {'vile' if i % 2 else 'kind'}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    assert len(toxicity.fit(df, labels).tokens) == 402
    monkeypatch.setattr(toxicity, "FIT_ROWS", 400)
    monkeypatch.setattr(toxicity, "FIT_TOKENS", 150)
    model = toxicity.fit(df, labels)
    assert 50 < len(model.tokens) <= 150
    assert [r["predicted"] for r in toxicity.score(df, model).orderBy("doc_id").collect()] == [i % 2 for i in range(400)]


def test_without_labels_nothing_is_toxic(spark, docs, none):
    df, labels = toxic_table(spark, 20)
    for label in (labels.where("false"), labels.where("toxic = 0")):
        got = toxicity.score(df, toxicity.fit(df, label)).collect()
        assert {r["predicted"] for r in got} == {0}
    assert toxicity.score(docs, toxicity.fit(none, labels)).count() == docs.count()


# ------------------------------------------------------------------ 8 repeated passages

def test_repeats_go(docs, none):
    rows = pairs(docs)
    got = by_id(substring_dedup.remove_repeats(docs, with_text=True))
    for (i, t), (n, gone, digest) in zip(rows, brute.kept_words([t for _, t in rows])):
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (n, gone, digest)
        assert brute.sha(" ".join(brute.words(got[i]["text"]))) == digest
    assert substring_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("length", [1, 4, 5, 13, 20, 27, 50])
def test_repeats_with_odd_ids_and_lengths(messy, length):
    keyed = sorted(common.keyed(messy).collect(), key=lambda r: r["uid"])
    expected = sorted(brute.kept_words([r["text"] for r in keyed], length))
    got = sorted((r["n_words"], r["n_removed"], r["kept_sha256"])
                 for r in substring_dedup.remove_repeats(messy, length).collect())
    assert sum(x[1] for x in got) == sum(x[1] for x in expected) and [x[:2] for x in got] == [x[:2] for x in expected]


def test_levels_double_until_nothing_is_left(spark, monkeypatch):
    assert [substring_dedup.levels(n) for n in (1, 9, 10, 20, 27, 50)] == [
        [1], [9], [5, 10], [5, 10, 20], [7, 14, 27], [7, 13, 25, 50]]
    looked, find = [], substring_dedup.repeated_anchors

    def spy(texts, length, part, before):
        out = find(texts, length, part, before)
        looked.append((part, out.count()))
        return out

    monkeypatch.setattr(substring_dedup, "repeated_anchors", spy)
    rng = random.Random(4)
    rows = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(60)) for _ in range(40)]
    long, short = rows[0].split()[:45], rows[1].split()[:8]
    rows[5] += " " + " ".join(long)          # 45 words come again
    rows[6] += " " + " ".join(short)         # 8 words: gone after the first level of 50
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert sum(r["n_removed"] for r in substring_dedup.remove_repeats(df, 20).collect()) == 45
    assert [p for p, _ in looked] == [5, 10] and looked[1][1] == 2
    looked.clear()
    plain = df.where("doc_id > 6")
    assert sum(r["n_removed"] for r in substring_dedup.remove_repeats(plain, 50).collect()) == 0
    assert looked == [(7, 0)]


# ------------------------------------------------------------------ 9 decontamination

def bench(spark, texts):
    long = next(t for t in texts if t and "same line" in t)
    items = [(1, long), (2, " ".join(brute.words(long)[16:40]).upper()), (3, "one two"), (4, ""), (5, None), (None, long),
             (10, "Never anywhere"), (2, "a b c"), (11, " ".join(brute.words(long)[16:40]))]
    return items, spark.createDataFrame(items, "item_id long, text string").withColumn("w", common.F.lit(1))


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 300])
def test_contamination(spark, docs, texts, block):
    items, table = bench(spark, texts)
    rows = pairs(docs)
    got = by_id(decontaminate.contamination(docs, table, block_bytes=block))
    for (i, _), expected in zip(rows, brute.contamination([t for _, t in rows], items)):
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == expected


@pytest.mark.parametrize("alone", [False, True])
def test_items_without_an_id_cover_words(spark, alone):
    text = [" ".join(f"{x}{i}" for i in range(30)) for x in "abc"]
    docs = spark.createDataFrame([(1, "x y " + text[0]), (2, text[1]), (3, text[2]), (4, text[1] + " " + text[0])],
                                 "doc_id long, text string")
    items = [(None, text[0])] + [(7, text[1]), (None, text[1][:50])] * (not alone)
    table = spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents(doc_id BIGINT, text VARCHAR); CREATE TABLE benchmark(item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [tuple(r) for r in docs.collect()])
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    # the twin counts NULL in n_items too
    columns = ["doc_id", "n_words", "n_hit", "items_sha256", "contaminated"]
    got = decontaminate.contamination(docs, table)
    assert differences(got.select(columns).toPandas(), con.execute(decontaminate.ORACLE).df()[columns]) == ""
    assert [by_id(got)[i]["n_hit"] for i in (1, 2, 3, 4)] == ([30, 0, 0, 30] if alone else [30, 30, 0, 60])
    assert [by_id(got)[i]["n_items"] for i in (1, 2, 3, 4)] == ([0] * 4 if alone else [0, 1, 0, 1])


def test_contamination_on_odd_tables(spark, docs, messy, none, texts):
    _, table = bench(spark, texts)
    assert decontaminate.contamination(messy, table).count() == messy.count()
    assert decontaminate.contamination(none, table).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.contamination(docs, table.where("false")).collect())


def test_proximity(spark):
    item = " ".join(f"t{i}" for i in range(6))
    near = "x x t0 t1 other t2 t3 t4 t5 x"
    df = spark.createDataFrame([(1, item), (2, near), (3, "t0 t1 t2 y y y y y t3 t4 t5")], "doc_id long, text string")
    keyed = common.keyed(df)
    block = next(decontaminate.blocks(spark.createDataFrame([(1, item)], "item_id long, text string"), "item_id", "text",
                                      13, 1 << 20))
    windows = decontaminate.order_windows(block, decontaminate.term_counts(keyed, block.terms))
    index = decontaminate.build_index(keyed, block.terms, windows, slop=2).where("term >= 0")
    table = decontaminate._window_table(spark, windows)
    assert [r["uid"] for r in decontaminate.phrase_matches(index, table).collect()] == [1]
    assert sorted(r["uid"] for r in decontaminate.proximity_matches(index, table, 2).collect()) == [1, 2]


@pytest.mark.parametrize("slop", [1, 2, 4])
def test_proximity_in_any_order_and_widely_spaced(spark, slop):
    rng = random.Random(slop)
    items = ["a b c", "d e a f", "b b g", "c"]
    rows = ["c x a x x x b", "a b c", "c b a", "x a", "", "b c x x a"] + [
        " ".join(rng.choice("aabbbccddeeffgxxxxxx") for _ in range(rng.randrange(1, 25))) for _ in range(150)]
    keyed = common.keyed(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    block = next(decontaminate.blocks(table, "item_id", "text", 13, 1 << 20))
    windows = decontaminate.order_windows(block, decontaminate.term_counts(keyed, block.terms))
    name = {int(t): w for w in "abcdefg" for t in decontaminate._places(
        block.terms, decontaminate.word_hashes(decontaminate.pa.array([w]))[0])}
    expected = set()
    for uid, text in enumerate(rows):
        w = text.split()
        for k in windows.itertuples():
            for start in (i - k.offsets[0] for i, x in enumerate(w) if x == name[k.terms[0]]):
                near = w[max(0, start - slop):max(0, start + k.size + slop)]
                if all(name[t] in near for t in k.terms):
                    expected.add((k.w, uid, start))
    index = decontaminate.build_index(keyed, block.terms, windows, slop).where("term >= 0")
    got = decontaminate.proximity_matches(index, decontaminate._window_table(spark, windows), slop)
    assert {tuple(r) for r in got.collect()} == expected and len(expected) > 50
