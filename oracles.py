"""SQL twins of the registered queries, for DuckDB, built from small pieces.

They share nothing with the package: resamples are drawn one by one from the hash spelled
out in integer arithmetic, fits of up to three features are closed forms (Cramer's rule;
for lasso every sign pattern is tried and the optimal one kept), and errors are summed over
the resampled rows themselves.
"""

from __future__ import annotations

from itertools import product

# The published XXH64 primes; 2**64 - 1.
P1, P2, P3 = 11400714785074694791, 14029467366897019727, 1609587929392839161
P4, P5 = 9650029242287828579, 2870177450012600261
MASK = "18446744073709551615::UHUGEINT"

ORDERS_REG = """
  SELECT o_orderkey AS row_id, coalesce(qty, 0) AS qty, coalesce(lines, 0)::DOUBLE AS lines,
         coalesce(disc, 0) AS disc, coalesce(y, 0) AS y,
         CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS test_set
  FROM orders LEFT JOIN (
    SELECT l_orderkey, sum(l_quantity) AS qty, count(*) AS lines, avg(l_discount) AS disc,
           sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS y
    FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""

ORDERS_ONE_HOT = f"""
  SELECT r.*, (o_orderstatus = 'F')::INTEGER::DOUBLE AS "orderstatus_F",
         (o_orderstatus = 'O')::INTEGER::DOUBLE AS "orderstatus_O"
  FROM ({ORDERS_REG}) r JOIN orders ON o_orderkey = row_id"""

ORDERS_LEVELS = "SELECT r.*, " + ", ".join(
    [f"(o_orderstatus = '{s}')::INTEGER::DOUBLE AS orderstatus_{s}" for s in "FOP"]
    + [f"(left(o_orderpriority, 1) = '{i}')::INTEGER::DOUBLE AS priority_P{i}" for i in range(1, 6)]
) + f" FROM ({ORDERS_REG}) r JOIN orders ON o_orderkey = row_id"

PART_LINE = """
  SELECT p_partkey AS row_id, p_partkey::DOUBLE AS partkey, p_size::DOUBLE AS size,
         p_retailprice AS y, 0 AS test_set FROM part"""

LASSO_DEFAULT = (0.05, 0.1, 0.2)
LASSO_GRID = (5.0, 500.0, 5000.0)
RIDGE_GRID = (1e-5, 1e-4, 1e-3, 1e-2, 0.1, 1.0, 10.0, 100.0, 1000.0, 10000.0)


def lit(x) -> str:
    return f"{float(x)!r}::DOUBLE"


def hash_step(name: str, source: str, keep: str, value: str, state: str) -> list[str]:
    """CTEs that add `h`, one XXH64 step of an 8-byte value on a state."""
    keep = keep + ", " if keep else ""

    def rotated(bits):
        return f"((x * {2 ** bits}) & {MASK} | (x >> {64 - bits}))"
    steps = [
        f"SELECT {keep}({state})::UHUGEINT AS s, "
        f"(({value})::UHUGEINT * {P2}::UHUGEINT) & {MASK} AS x FROM {source}",
        f"SELECT {keep}xor(({rotated(31)} * {P1}::UHUGEINT) & {MASK}, "
        f"(s + {P5 + 8}::UHUGEINT) & {MASK}) AS x FROM @",
        f"SELECT {keep}({rotated(27)} * {P1}::UHUGEINT + {P4}::UHUGEINT) & {MASK} AS x FROM @",
        f"SELECT {keep}(xor(x, x >> 33) * {P2}::UHUGEINT) & {MASK} AS x FROM @",
        f"SELECT {keep}(xor(x, x >> 29) * {P3}::UHUGEINT) & {MASK} AS x FROM @",
        f"SELECT {keep}xor(x, x >> 32) AS h FROM @",
    ]
    out, before = [], source
    for i, sql in enumerate(steps):
        last = i == len(steps) - 1
        this = name if last else f"{name}_{i}"
        out.append(f"{this} AS ({sql.replace('@', before)})")
        before = this
    return out


class Sql:
    """A list of CTEs and what they are about."""

    def __init__(self, table: str = ORDERS_REG, features=("qty", "lines", "disc"),
                 split: str = "test_set = 0", seeds=(0, 5), k: int = 3):
        self.features, self.k, self.seeds = list(features), k, seeds
        cols = self.features + ["y"]
        self.ctes = [
            f"reg AS MATERIALIZED ({table})",
            f"train AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS position, "
            + ", ".join(f"{c} - avg({c}) OVER () AS d_{c}" for c in cols)
            + f" FROM reg WHERE {split})",
            "size AS MATERIALIZED (SELECT count(*) AS n, greatest(4096, "
            "ceil(count(*) / 2097152.0)::BIGINT) AS cell, "
            + ", ".join(f"avg({c}) AS m_{c}" for c in cols) + " FROM train)",
            f"seeds AS (SELECT range AS seed FROM range({seeds[0]}, {seeds[0] + seeds[1]}))",
        ]

    def fold(self, draw: str) -> str:
        """Contiguous folds of draw numbers, the first n mod k one longer."""
        k = self.k
        return (f"CASE WHEN {draw} < (n // {k} + 1) * (n % {k}) THEN {draw} // (n // {k} + 1) "
                f"ELSE n % {k} + ({draw} - (n // {k} + 1) * (n % {k})) // (n // {k}) END::INTEGER")

    def draws(self) -> "Sql":
        """draws(seed, fold, cell, draw_in_cell, position)."""
        c = self.ctes
        c.append("d0 AS (SELECT seed, unnest(range((SELECT n FROM size))) AS draw FROM seeds)")
        c += hash_step("d1", "d0", "seed, draw", "seed", "42")
        c += hash_step("d2", "d1", "seed, draw", "draw", "h")
        c.append(f"d3 AS (SELECT seed, {self.fold('draw')} AS fold, "
                 "(((h >> 1)::BIGINT % n) // cell)::BIGINT AS cell FROM d2, size)")
        c.append("d4 AS (SELECT seed, cell, fold, count(*)::BIGINT AS c FROM d3 GROUP BY ALL)")
        c.append("d5 AS (SELECT *, (sum(c) OVER (PARTITION BY seed, cell ORDER BY fold))::BIGINT "
                 "- c AS first FROM d4)")
        c.append("d6 AS (SELECT seed, fold, cell, unnest(range(first, first + c)) "
                 "AS draw_in_cell FROM d5)")
        keep = "seed, fold, cell, draw_in_cell"
        c += hash_step("d7", "d6", keep, "seed", "42")
        c += hash_step("d8", "d7", keep, "cell", "h")
        c += hash_step("d9", "d8", keep, "draw_in_cell", "h")
        c.append("draws AS MATERIALIZED (SELECT seed, fold, d9.cell AS cell, draw_in_cell, "
                 "d9.cell * size.cell + (h >> 1)::BIGINT "
                 "% least(size.cell, n - d9.cell * size.cell) AS position FROM d9, size)")
        return self

    def weights(self) -> "Sql":
        """w(seed, fold, row_id, w) and the weighted rows `rows`."""
        self.draws()
        self.ctes.append("w AS MATERIALIZED (SELECT seed, fold, row_id, count(*)::INTEGER AS w "
                         "FROM draws JOIN train USING (position) GROUP BY ALL)")
        self.ctes.append("rows AS MATERIALIZED (SELECT w.seed, w.fold, w.w, train.* "
                         "FROM w JOIN train USING (row_id))")
        return self

    def moments(self) -> "Sql":
        """mom(seed, fold, s_a_b...): weighted sums of products about the overall means, and
        blocks(seed, fold, n, centred c_a_b, mean offsets): each training set, fold -1 = all."""
        self.weights()
        z = ["1"] + self.features + ["y"]
        pairs = [(a, b) for i, a in enumerate(z) for b in z[i:]]

        def value(a):
            return "1" if a == "1" else f"d_{a}"
        sums = ", ".join(f"sum(w * {value(a)} * {value(b)})::DOUBLE AS s_{a}_{b}" for a, b in pairs)
        names = [f"s_{a}_{b}" for a, b in pairs]
        self.ctes.append(f"mom AS MATERIALIZED (SELECT seed, fold, {sums} FROM rows GROUP BY ALL)")
        self.ctes.append("tot AS (SELECT seed, " + ", ".join(f"sum({s}) AS {s}" for s in names)
                         + " FROM mom GROUP BY ALL)")
        self.ctes.append(
            "trn AS (SELECT seed, -1 AS fold, " + ", ".join(names) + " FROM tot UNION ALL "
            "SELECT mom.seed, fold, " + ", ".join(f"tot.{s} - mom.{s}" for s in names)
            + " FROM mom JOIN tot USING (seed))")
        centred = ", ".join(f"s_{a}_{b} - s_1_{a} * s_1_{b} / s_1_1 AS c_{a}_{b}"
                            for a, b in pairs if a != "1")
        means = ", ".join(f"m_{a} + s_1_{a} / s_1_1 AS mean_{a}" for a in z[1:])
        self.ctes.append(f"blocks AS MATERIALIZED (SELECT seed, fold, s_1_1 AS n, {centred}, "
                         f"{means} FROM trn, size)")
        return self

    # ------------------------------------------------------------------ closed-form fits

    def fit(self, name: str, method: str, features, alphas=()) -> "Sql":
        """fit_<name>(seed, fold, alpha, b_<feature>..., b0) for all training sets,
        path_<name>(seed, alpha, fold, mse, r2), best_<name>(seed, alpha),
        coef_<name>(seed, alpha, b..., b0), full_<name> = coef + r2."""
        m, f = len(features), list(features)

        def c(i, j):
            a, b = sorted((i, j), key=lambda x: self.features.index(x))
            return f"c_{a}_{b}"
        ridge = method == "ridge"
        lasso = method == "lasso"
        grid = ("(SELECT unnest([" + ", ".join(lit(a) for a in alphas) + "]) AS alpha)"
                if alphas else "(SELECT NULL::DOUBLE AS alpha)")
        source = f"blocks, {grid}"
        if lasso:
            for i in range(m):
                source += f", (SELECT unnest([-1, 0, 1]) AS sign_{i}) AS t{i}"
        lhs, rhs = [], []
        for i in range(m):
            for j in range(m):
                e = c(f[i], f[j]) + (" + alpha" if ridge and i == j else "")
                if lasso:
                    e = (f"CASE WHEN sign_{i} <> 0 AND sign_{j} <> 0 THEN {e} "
                         f"ELSE {int(i == j)} END")
                lhs.append(f"{e} AS a{i}{j}")
            e = f"c_{f[i]}_y"
            if lasso:
                e = f"CASE WHEN sign_{i} <> 0 THEN {e} - n * alpha * sign_{i} ELSE 0 END"
            rhs.append(f"{e} AS r{i}")
        self.ctes.append(f"sys_{name} AS (SELECT *, {', '.join(lhs + rhs)} FROM {source})")

        def det(cell):
            if m == 1:
                return cell(0, 0)
            if m == 2:
                return f"({cell(0, 0)} * {cell(1, 1)} - {cell(0, 1)} * {cell(1, 0)})"
            return "(" + " ".join(
                f"{s} {cell(0, p)} * ({cell(1, q)} * {cell(2, r)} - {cell(1, r)} * {cell(2, q)})"
                for s, (p, q, r) in zip("+-+", ((0, 1, 2), (1, 0, 2), (2, 0, 1)))) + ")"

        whole = det(lambda i, j: f"a{i}{j}")
        solved = [f"{det(lambda i, j, k=k: f'r{i}' if j == k else f'a{i}{j}')} / {whole} AS b_{f[k]}"
                  for k in range(m)]
        keep = "seed, fold, alpha, n"
        if lasso:
            self.ctes.append(f"try_{name} AS (SELECT *, {', '.join(solved)} FROM sys_{name})")
            ok = [f"CASE WHEN sign_{i} <> 0 THEN b_{f[i]} * sign_{i} > 0 ELSE abs(c_{f[i]}_y - ("
                  + " + ".join(f"{c(f[i], f[j])} * (CASE WHEN sign_{j} <> 0 THEN b_{f[j]} ELSE 0 END)"
                               for j in range(m))
                  + ")) <= n * alpha END" for i in range(m)]
            b = ", ".join(f"CASE WHEN sign_{i} <> 0 THEN b_{f[i]} ELSE 0 END AS b_{f[i]}"
                          for i in range(m))
            self.ctes.append(
                f"sol_{name} AS (SELECT {keep}, {b}, mean_y, "
                + ", ".join(f"mean_{x}" for x in f) + f" FROM try_{name} WHERE {' AND '.join(ok)})")
        else:
            self.ctes.append(f"sol_{name} AS (SELECT {keep}, {', '.join(solved)}, mean_y, "
                             + ", ".join(f"mean_{x}" for x in f) + f" FROM sys_{name})")
        level = "mean_y - " + " - ".join(f"b_{x} * mean_{x}" for x in f)
        bs = ", ".join(f"b_{x}" for x in f)
        self.ctes.append(f"fit_{name} AS MATERIALIZED (SELECT seed, fold, alpha, {bs}, "
                         f"{level} AS b0 FROM sol_{name})")
        error = "y - b0 - " + " - ".join(f"b_{x} * {x}" for x in f)
        if alphas:
            self.ctes.append(
                f"path_{name} AS MATERIALIZED (SELECT seed, alpha, fold, "
                f"sum(w * ({error}) ** 2) / sum(w) AS mse, 1 - sum(w * ({error}) ** 2) / "
                f"sum(w * (y - held) ** 2) AS r2 FROM (SELECT *, sum(w * y) OVER "
                "(PARTITION BY seed, fold) / sum(w) OVER (PARTITION BY seed, fold) AS held "
                f"FROM rows) JOIN fit_{name} USING (seed, fold) GROUP BY ALL)")
            order = "mse_mean, alpha DESC" if lasso else "r2_mean DESC, alpha"
            self.ctes.append(
                f"best_{name} AS (SELECT seed, alpha FROM (SELECT seed, alpha, avg(mse) AS "
                "mse_mean, avg(r2) AS r2_mean FROM path_" + name + " GROUP BY ALL) QUALIFY "
                f"row_number() OVER (PARTITION BY seed ORDER BY {order}) = 1)")
            self.ctes.append(f"coef_{name} AS MATERIALIZED (SELECT seed, alpha, {bs}, b0 FROM "
                             f"fit_{name} JOIN best_{name} USING (seed, alpha) WHERE fold = -1)")
        else:
            self.ctes.append(f"coef_{name} AS MATERIALIZED (SELECT seed, alpha, {bs}, b0 "
                             f"FROM fit_{name} WHERE fold = -1)")
        self.ctes.append(
            f"score_{name} AS MATERIALIZED (SELECT seed, 1 - sum(w * ({error}) ** 2) / "
            "sum(w * (y - middle) ** 2) AS r2 FROM (SELECT *, sum(w * y) OVER "
            "(PARTITION BY seed) / sum(w) OVER (PARTITION BY seed) AS middle FROM rows) "
            f"JOIN coef_{name} USING (seed) GROUP BY seed)")
        return self

    def long(self, name: str, features, label: str | None = None) -> str:
        """SELECT (model, seed, feature, is_intercept, coef) of a fitted model."""
        label = label or name
        return " UNION ALL ".join(
            f"SELECT '{label}' AS model, seed, '{x}' AS feature, {flag} AS is_intercept, "
            f"{col} + 0.0 AS coef FROM coef_{name}"
            for x, flag, col in [(x, "false", f"b_{x}") for x in features]
            + [("intercept", "true", "b0")])

    def metrics(self, models: dict[str, list[str]], where: str = "test_set = 1") -> "Sql":
        """metrics(model, seed, rmse, r2) on the rows chosen by `where`."""
        parts = []
        for name, f in models.items():
            hat = "b0 + " + " + ".join(f"b_{x} * {x}" for x in f)
            parts.append(f"SELECT '{name}' AS model, seed, row_id, y, {hat} AS prediction "
                         f"FROM coef_{name}, (SELECT * FROM reg WHERE {where})")
        self.ctes.append(f"pred AS MATERIALIZED ({' UNION ALL '.join(parts)})")
        self.ctes.append(
            "metrics AS MATERIALIZED (SELECT model, seed, sqrt(avg((y - prediction) ** 2)) AS rmse, "
            "1 - sum((y - prediction) ** 2) / (var_pop(y) * count(*)) AS r2 FROM pred GROUP BY ALL)")
        return self

    def select(self, sql: str) -> str:
        return "WITH " + ",\n".join(self.ctes) + "\n" + sql


def distribution(value: str, prefix: str, digits: int) -> str:
    return (f"round(avg({value}), {digits}) AS {prefix}mean, "
            f"round(stddev_pop({value}), {digits}) AS {prefix}se, "
            f"round(quantile_cont({value}, 0.025), {digits}) AS {prefix}lower, "
            f"round(quantile_cont({value}, 0.975), {digits}) AS {prefix}upper")
