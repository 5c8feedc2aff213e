"""Personal data spans by weak supervision, in SQL functions alone.

Strict patterns give the base spans, which always stay. Wider patterns propose further candidates.
Labelers vote on each candidate: the strict pattern, a gazetteer of issuers, top-level domains and
calling codes, the words before it, and its shape. Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is, and a logistic span classifier is trained on
the outcome; candidates it accepts are added. What the driver sees are counts of vote patterns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
# The strict patterns without backtracking: a match can only begin where a run of its first
# character class begins, or where the last match ended (\G), and runs are taken whole.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\)|\{at\})\x20?[A-Za-z0-9-]{1,63}+"
             r"(?:\x20?(?:\.|\[dot\]|\(dot\)|\{dot\})\x20?[A-Za-z0-9-]{1,63}+){1,5}+",
    "ip": r"(?<![0-9.\[])[0-9]{1,3}+(?:\[\.\][0-9]{1,3}+){3}+(?![0-9.])",
    "card": r"(?<![0-9._/-])[0-9]{4}+(?:[._/][0-9]{4}+){3}+(?![0-9._/-])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{2,4}+\)\x20?|00[0-9]{1,3}+[\x20.-])[0-9]{2,4}+(?:[\x20.-][0-9]{2,4}+){1,4}+"
             r"(?![0-9]|[\x20.-][0-9])",
}
HINT = {"email": "[@\\[({]", "ip": "[0-9]\\]?\\.", "card": "[0-9]{4}|[0-9][\\x20-][0-9]", "phone": "\\+[0-9]|\\([0-9]|00[0-9]"}

# Issuer prefixes, common top-level domains, calling codes, cue words.
ISSUER = r"^(?:4|5[1-5]|2[2-7]|3[0478]|6011|65|35|62)"
DOMAIN = r"(?i)\.\x20?(?:com|org|net|edu|gov|io|de|fr|es|it|uk|eu|ru|cn|jp|br|in|info|example)$"
CALLING = r"^(?:\+|00)?\x20?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CUES = {
    "email": "e-?mail|mail|contact|write|kontakt|courriel|correo",
    "ip": "ip|host|server|address|addr|login|adresse|servidor",
    "card": "card|visa|credit|amex|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|cell|telefon|téléphone|teléfono|appelez",
}
AGAINST = "version|isbn|order|invoice|serial|figure|section|page|article|id|no"
AROUND = 32          # characters before a span that are read for cue words
LABELERS = ("strict", "gazetteer", "context", "shape")
ACCEPT = 0.5


def _digits(x: str) -> str:
    return f"regexp_replace({x}, '[^0-9]', '')"


def _luhn(d: str) -> str:
    """Digits from the right; every second one is doubled and its digits are summed."""
    digit = f"int(substr(reverse({d}), i, 1))"
    return (f"aggregate(sequence(1, length({d})), 0, (a, i) -> a + IF(i % 2 = 1, {digit}, "
            f"2 * {digit} - IF({digit} > 4, 9, 0))) % 10 = 0")


VALID = {
    "email": "true",
    "ip": "forall(split({x}, '[.]'), q -> length(ltrim('0', q)) <= 3 AND int(concat('0', right(q, 3))) <= 255)",
    "card": f"length({_digits('{x}')}) BETWEEN 14 AND 19 AND {_luhn(_digits('{x}'))}",
    "phone": f"length({_digits('{x}')}) BETWEEN 10 AND 15",
}


def _found(df: DataFrame, kind: str, pattern: str, name: str) -> DataFrame:
    """Adds ``name``: all matches as (s, e, x), code points with the end exclusive. The texts
    between the matches give their places."""
    text = F.when(F.col("text").rlike(HINT[kind]), F.col("text")).otherwise("")
    df = df.withColumn("_x", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    df = df.withColumn("_g", F.when(F.size("_x") > 0, F.split("text", pattern, -1)).otherwise(F.array()))
    df = df.withColumn("_z", F.expr("zip_with(_x, slice(_g, 1, size(_x)), (x, g) -> struct(x, length(g) AS g))"))
    return df.withColumn(name, F.expr(
        "aggregate(_z, struct(0 AS at, CAST(array() AS array<struct<s:int,e:int,x:string>>) AS out), "
        "(a, m) -> struct(a.at + m.g + length(m.x) AS at, array_append(a.out, "
        "struct(a.at + m.g AS s, a.at + m.g + length(m.x) AS e, m.x AS x)) AS out)).out")).drop("_x", "_g", "_z")


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)``: base spans and candidates as structs (k, s, e, base, votes..., size)."""
    df = common.pick(docs, doc_id=id_col, text=F.coalesce(common._column(text_col).cast("string"), F.lit("")))
    every = []
    for k, kind in enumerate(KINDS):
        df = _found(df, kind, STRICT[kind], "_m")
        df = df.withColumn(f"_b{k}", F.expr(f"filter(_m, m -> {VALID[kind].format(x='m.x')})")).drop("_m")
        df = _found(df, kind, WIDE[kind], "_m")
        df = df.withColumn(f"_w{k}", F.expr(
            f"filter(_m, m -> NOT exists(_b{k}, b -> m.s < b.e AND b.s < m.e))")).drop("_m")
        for name, base in ((f"_b{k}", "true"), (f"_w{k}", "false")):
            every.append(f"transform({name}, m -> {_votes(k, kind, base)})")
    return df.select("doc_id", F.expr(f"concat({', '.join(every)})").alias("spans"))


def _votes(k: int, kind: str, base: str) -> str:
    """One span with its votes: 1 for, -1 against, 0 for no opinion."""
    before = f"lower(substring(text, greatest(1, m.s + 1 - {AROUND}), least(m.s, {AROUND})))"
    context = (f"CASE WHEN {before} RLIKE '(?<![a-z])(?:{CUES[kind]})[^a-z0-9]' THEN 1 "
               f"WHEN {before} RLIKE '(?<![a-z])(?:{AGAINST})[^a-z0-9]{{1,3}}$' THEN -1 ELSE 0 END")
    digits = _digits("m.x")
    gazetteer = {"email": f"m.x RLIKE '{_sql(DOMAIN)}'", "ip": f"NOT {digits} RLIKE '^0'",
                 "card": f"{digits} RLIKE '{ISSUER}'", "phone": f"m.x RLIKE '{_sql(CALLING)}' OR m.x LIKE '(%'"}[kind]
    shape = {"email": "length(m.x) BETWEEN 6 AND 100",
             "ip": "forall(split(m.x, '[^0-9]+'), q -> q = '' OR int(concat('0', right(q, 3))) <= 255)",
             "card": f"length({digits}) BETWEEN 14 AND 19 AND {_luhn(digits)}",
             "phone": f"length({digits}) BETWEEN 9 AND 15"}[kind]
    return (f"struct({k} AS k, m.s AS s, m.e AS e, {base} AS base, IF({base}, 1, 0) AS strict, "
            f"IF({gazetteer}, 1, -1) AS gazetteer, {context} AS context, IF({shape}, 1, -1) AS shape, "
            f"least(3, length({digits}) div 5) AS size)")


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\")


@dataclass
class Classifier:
    """Reliabilities by labeler, and the weights of the final classifier over the vote features."""

    reliability: dict[str, tuple[float, float]]
    weights: dict[str, float]

    def sql(self, c: str = "c") -> str:
        """Probability that the span ``c`` is personal data."""
        terms = [f"({w!r}D) * IF({name.replace('#', c)}, 1D, 0D)" for name, w in self.weights.items()]
        return f"1 / (1 + exp(-({' + '.join(terms)})))"


FEATURES = ("true", *[f"#.{name} = {v}" for name in LABELERS for v in (1, -1)],
            *[f"#.k = {k}" for k in range(len(KINDS))], *[f"#.size = {i}" for i in range(4)])


def _value(feature: str, row: dict) -> float:
    if feature == "true":
        return 1.0
    name, value = feature[2:].split(" = ")
    return float(row[name] == int(value))


def train(candidates: DataFrame, rounds: int = 50) -> Classifier:
    """EM and the classifier from the counts of vote patterns of ``spans`` (all of them); there are
    at most 4 * 2 * 2 * 3 * 2 * 4 patterns, however many spans."""
    keys = ["k", *LABELERS, "size"]
    rows = [r.asDict() for r in candidates.select(F.explode("spans").alias("c")).select("c.*")
            .groupBy(*keys).agg(F.count("*").alias("n")).collect()]
    # P(vote | personal), P(vote | other), held by pseudo-counts that say which side a vote is on
    table = {name: {1: (0.8, 0.3), -1: (0.1, 0.5), 0: (0.1, 0.2)} for name in LABELERS}
    table["strict"] = {1: (0.9, 0.05), -1: (0.05, 0.05), 0: (0.05, 0.9)}
    anchor, share = 20.0, 0.5
    first = {name: dict(v) for name, v in table.items()}
    for _ in range(rounds):
        for r in rows:
            a, b = math.log(share), math.log(1 - share)
            for name in LABELERS:
                p, q = table[name][r[name]]
                a, b = a + math.log(p), b + math.log(q)
            r["p"] = 1 / (1 + math.exp(max(-700.0, min(700.0, b - a))))
        total = sum(r["n"] for r in rows)
        yes = sum(r["n"] * r["p"] for r in rows)
        share = (yes + 10) / (total + 20)
        for name in LABELERS:
            for v in (1, -1, 0):
                n1 = sum(r["n"] * r["p"] for r in rows if r[name] == v)
                n0 = sum(r["n"] * (1 - r["p"]) for r in rows if r[name] == v)
                p, q = first[name][v]
                table[name][v] = ((n1 + anchor * p) / (yes + anchor), (n0 + anchor * q) / (total - yes + anchor))
    return Classifier({name: table[name][1] for name in LABELERS}, _logistic(rows))


def _logistic(rows: list[dict], steps: int = 400, ridge: float = 1.0) -> dict[str, float]:
    """Gradient steps for a logistic curve on the estimated probabilities, by pattern."""
    x = [[_value(f, r) for f in FEATURES] for r in rows]
    total = sum(r["n"] for r in rows) or 1
    w = [0.0] * len(FEATURES)
    for _ in range(steps):
        slope = [-ridge * a / total for a in w]
        for xi, r in zip(x, rows):
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, xi))))))
            for i, v in enumerate(xi):
                if v:
                    slope[i] += r["n"] * (r["p"] - p) / total
        w = [a + b for a, b in zip(w, slope)]
    return dict(zip(FEATURES, w))


def _text(spans_sql: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    order = f"array_sort(transform({spans_sql}, c -> struct(c.s AS s, c.k AS k, c.e AS e)))"
    return F.expr(f"array_join(transform({order}, c -> concat_ws(':', element_at(array({names}), c.k + 1), "
                  "CAST(c.s AS string), CAST(c.e AS string))), ',')")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans)`` per row: counts and digest of the
    base spans, and base and accepted spans as ``kind:start:end`` by start, then kind.

    NULL and empty texts have no spans; ids are only passed on, and rows need no shuffle.
    """
    found = common.stage(spans(docs, id_col, text_col), "spans")
    model = train(found)
    every = f"filter(spans, c -> c.base OR {model.sql()} > {ACCEPT})"
    return found.select(
        "doc_id", *[F.expr(f"CAST(size(filter(spans, c -> c.base AND c.k = {k})) AS bigint)").alias(f"n_{kind}")
                    for k, kind in enumerate(KINDS)],
        F.sha2(_text("filter(spans, c -> c.base)").cast("binary"), 256).alias("base_sha256"),
        _text(every).alias("spans"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(common.table(spark, sf_dir, "documents"))
