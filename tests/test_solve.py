"""The dense solvers on moment blocks, against the plain way and their optimality conditions."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

import brute
from bootloom.operators import solve
from bootloom.operators.moments import _Grams, _long, design, unpack


def gram(x, y, w=None, centre=True):
    z = np.column_stack([np.ones(len(y)), x, y])
    if centre:
        z[:, 1:] -= z[:, 1:].mean(axis=0)
    return _Grams(z).under((np.ones(len(y)) if w is None else w)[None, :].astype(int))[0]


def sample(seed, n=60, m=4, noise=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, m)) * rng.uniform(0.1, 30, m) + rng.uniform(-50, 50, m)
    b = rng.normal(size=m) * (rng.random(m) < 0.6)
    return x, x @ b + rng.normal(size=n) * noise + 5


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 6), st.floats(0.01, 20))
def test_lasso_meets_its_optimality_conditions(seed, alpha):
    x, y = sample(seed)
    block = solve.Block.of(gram(x, y))
    b = solve.fit_lasso(block, alpha)
    slope = block.xy - block.xx @ b
    scale = np.sqrt(np.diag(block.xx) * block.yy)
    on = b != 0
    assert np.all(np.abs(slope[on] - np.sign(b[on]) * alpha * block.n) <= 1e-8 * scale[on])
    assert np.all(np.abs(slope[~on]) <= alpha * block.n + 1e-8 * scale[~on])


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 6))
def test_least_squares_meets_the_normal_equations(seed):
    x, y = sample(seed)
    block = solve.Block.of(gram(x, y))
    b = solve.fit_linear(block)
    assert np.allclose(block.xx @ b, block.xy, rtol=0, atol=1e-9 * np.abs(block.xy).max())
    assert block.r2(b) <= 1
    assert np.allclose(b, brute.least_squares(x, y)[0], rtol=1e-7, atol=1e-9)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10 ** 6), st.floats(0.001, 100))
def test_weights_are_copies(seed, alpha):
    x, y = sample(seed)
    draw = np.random.default_rng(seed + 1).integers(0, len(y), len(y))
    w = np.bincount(draw, minlength=len(y))
    block = solve.Block.of(gram(x, y, w))
    centre = x.mean(axis=0)
    for method in solve.METHODS:
        b = solve.fit(method, block, alpha)
        want, b0 = brute.fit(method, x[draw], y[draw], alpha)
        # Some directions are poorly determined, so fitted values are compared.
        assert np.allclose(x @ b, x @ want, rtol=1e-5, atol=1e-5 * y.std())
        got0 = block.intercept(b) + y.mean() - centre @ b
        assert np.isclose(got0, b0, rtol=1e-5, atol=1e-5 * y.std())


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10 ** 6), st.sampled_from(solve.METHODS))
def test_cross_validation_equals_refits_on_rows(seed, method):
    x, y = sample(seed, n=90)
    draw = np.random.default_rng(seed + 1).integers(0, len(y), len(y))
    fold = np.repeat([0, 1, 2], 30)
    z = np.column_stack([np.ones(len(y)), x - x.mean(axis=0), y - y.mean()])
    w = np.stack([np.bincount(draw[fold == f], minlength=len(y)) for f in range(3)])
    folds = _Grams(z).under(w)
    alphas = (0.05, 0.5, 5.0)
    got = solve.solve_one(method, folds, alphas)
    alpha, b, _, r2, path = brute.cross_validated(method, x[draw], y[draw], fold, alphas)
    assert got["alpha"] == alpha
    assert np.isclose(got["r2"], r2, rtol=1e-9)
    assert np.allclose(got["coef"], b, rtol=1e-6, atol=1e-7)
    if method != "linear":
        assert np.isclose(got["mse_min"], min(v[0] for v in path.values()), rtol=1e-8)
        for a, f, mse, score in got["path"]:
            assert np.isclose(mse, path[a, f][0], rtol=1e-8)
            assert np.isclose(score, path[a, f][1], rtol=1e-8)
    else:
        assert got["alpha"] is None and got["mse_min"] is None


def test_ridge_tends_to_least_squares():
    x, y = sample(5)
    block = solve.Block.of(gram(x, y))
    assert np.allclose(solve.fit_ridge(block, 1e-9), solve.fit_linear(block), rtol=1e-6)


def test_a_constant_added_to_the_target_moves_the_intercept_only():
    x, y = sample(6)
    for method in solve.METHODS:
        a = solve.fit(method, solve.Block.of(gram(x, y, centre=False)), 0.5)
        b = solve.fit(method, solve.Block.of(gram(x, y + 1000, centre=False)), 0.5)
        assert np.allclose(a, b, rtol=1e-6, atol=1e-8)


def test_collinear_least_squares_is_the_shortest_solution():
    x, y = sample(7, m=3)
    x = np.column_stack([x, x[:, 0] * 2, x[:, 1] + x[:, 2], np.full(len(y), 3.0)])
    b = solve.fit_linear(solve.Block.of(gram(x, y)))
    want, _ = brute.least_squares(x, y)
    assert np.allclose(b, want, rtol=1e-6, atol=1e-8)
    assert b[-1] == 0


def test_collinear_lasso_still_meets_its_conditions():
    x, y = sample(8, m=3)
    block = solve.Block.of(gram(np.column_stack([x, x[:, 0], x[:, 1]]), y))
    b = solve.fit_lasso(block, 0.3)
    slope = block.xy - block.xx @ b
    assert np.all(np.abs(slope) <= 0.3 * block.n * (1 + 1e-6))
    assert np.isclose(np.abs(b).sum(), np.abs(solve.fit_lasso(solve.Block.of(gram(x, y)), 0.3)).sum(),
                      rtol=1e-5)


def test_nearly_collinear_lasso_is_right_or_an_error(monkeypatch):
    rng = np.random.default_rng(60)
    base = rng.normal(size=400)
    x = base[:, None] + 1e-5 * rng.normal(size=(400, 60))
    y = x @ rng.normal(size=60) * 100 + rng.normal(size=400)
    block = solve.Block.of(gram(x, y))
    for sweeps in (50, 400):
        monkeypatch.setattr(solve, "SWEEPS", sweeps)
        try:
            b = solve.fit_lasso(block, 1e-6)
        except ArithmeticError as e:
            assert "not converged" in str(e)
        else:
            slope = block.xy - block.xx @ b
            assert np.all(np.abs(slope) <= 1e-6 * block.n * 1.01 + 1e-9 * np.sqrt(np.diag(block.xx) * block.yy))


def conditions(block, b, alpha, tolerance=1e-8):
    slope, limit = block.xy - block.xx @ b, alpha * block.n
    scale = np.sqrt(np.diag(block.xx) * block.yy) * tolerance
    on = b != 0
    assert np.all(np.abs(slope[on] - np.sign(b[on]) * limit) <= scale[on])
    assert np.all(np.abs(slope) <= limit + scale)


@pytest.mark.parametrize("m, n, shared", [(4, 60, 0.0), (60, 400, 0.999), (60, 400, 1 - 1e-10), (60, 40, 0.0), (150, 100, 0.5)])
def test_the_path_needs_no_descent(monkeypatch, m, n, shared):
    monkeypatch.setattr(solve, "fit_lasso", None)
    rng = np.random.default_rng(m)
    x = shared ** 0.5 * rng.normal(size=(n, 1)) + (1 - shared) ** 0.5 * rng.normal(size=(n, m))
    block = solve.Block.of(gram(x, x[:, :3].sum(axis=1) + rng.normal(size=n)))
    top = np.abs(block.xy).max() / block.n
    fits = solve.lasso_path(block, [top * f for f in (1.1, 0.7, 0.1, 0.01, 1e-4)])
    assert not fits[top * 1.1].any()
    for alpha, b in fits.items():
        conditions(block, b, alpha)


def test_nearly_collinear_path_meets_its_conditions(monkeypatch):
    rng = np.random.default_rng(60)
    base = rng.normal(size=400)
    x = base[:, None] + 1e-5 * rng.normal(size=(400, 60))
    y = x @ rng.normal(size=60) * 100 + rng.normal(size=400)
    monkeypatch.setattr(solve, "SWEEPS", 0)
    for alpha in (1.0, 1e-3, 1e-6):
        conditions(solve.Block.of(gram(x, y)), solve.fit("lasso", solve.Block.of(gram(x, y)), alpha), alpha)


def test_path_with_copies_sums_and_ties():
    x, y = sample(8, m=4)
    wide = np.column_stack([x, x[:, 0], -x[:, 1], x[:, 1] + x[:, 2], x[:, 0]])
    block, plain = solve.Block.of(gram(wide, y)), solve.Block.of(gram(wide[:, :7], y))
    for alpha in (30.0, 1.0, 0.01, 1e-5):
        b = solve.fit("lasso", block, alpha)
        conditions(block, b, alpha)
        assert np.isclose(np.abs(b).sum(), np.abs(solve.fit("lasso", plain, alpha)).sum(), rtol=1e-6)


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10 ** 6))
def test_knots_are_where_the_set_changes(seed):
    x, y = sample(seed, m=6)
    block = solve.Block.of(gram(x, y))
    knots = list(solve.Homotopy(block).knots(1e-3 * block.n))
    inside = set()
    for one, two in zip(knots, [*knots[1:], None]):
        (inside.add if one.enters else inside.remove)(one.feature)
        until = two.limit if two else 1e-3 * block.n
        b = solve.fit("lasso", block, (one.limit + until) / 2 / block.n)
        assert set(np.flatnonzero(b).tolist()) == inside or one.limit - until < 1e-9 * one.limit


def test_ridge_of_a_column_that_is_a_sum():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 5)) * [1, 10, 100, 1, 0.1]
    x = np.column_stack([x, x[:, 0] + x[:, 1], np.ones(500)])
    y = x @ [1, 2, 0.1, 3, 5, 0, 0] + rng.normal(size=500)
    centred = x[:, :6] - x[:, :6].mean(axis=0)
    u, s, v = np.linalg.svd(centred, full_matrices=False)
    spectrum = solve.Spectrum(solve.Block.of(gram(x, y)))
    for alpha in (1e-5, 0.01, 10.0):
        want = v.T @ (s / (s * s + alpha) * (u.T @ (y - y.mean())))
        b = spectrum.fit(alpha)
        assert np.abs(b[:6] - want).max() < 1e-6 and b[6] == 0
        assert spectrum.degrees(alpha) == pytest.approx((s[:5] ** 2 / (s[:5] ** 2 + alpha)).sum(), rel=1e-9)


def test_columns_that_vanish_from_a_resample_get_zero():
    x, y = sample(9)
    x = np.column_stack([x, (np.arange(len(y)) < 3).astype(float)])
    w = np.ones(len(y), dtype=int)
    w[:3] = 0
    block = solve.Block.of(gram(x, y, w))
    for method in solve.METHODS:
        assert solve.fit(method, block, 0.1)[-1] == 0


def test_zeros_are_plain_zeros():
    x, y = sample(10)
    b = solve.fit_lasso(solve.Block.of(gram(x, y)), 1e9)
    assert b.tolist() == [0.0] * 4 and not np.signbit(b).any()


def test_constant_target():
    x, _ = sample(11)
    block = solve.Block.of(gram(x, np.full(len(x), 4.0)))
    b = solve.fit_linear(block)
    assert np.all(b == 0) and np.isnan(block.r2(b))
    assert solve.ratio(0.0, 1.0) == float("-inf")


def test_ties_lasso_takes_the_larger_penalty_ridge_the_first():
    cells = [(a, f, 1.0, 0.5) for a in (0.05, 0.1, 0.2) for f in range(3)]
    assert solve.best_alpha("lasso", cells, [0.05, 0.1, 0.2]) == 0.2
    assert solve.best_alpha("ridge", cells, [0.1, 0.05, 0.2]) == 0.1


def test_smallest_cell_is_not_the_smallest_mean():
    x, y = sample(12, n=90)
    z = np.column_stack([np.ones(90), x, y])
    folds = np.stack([z[f::3].T @ z[f::3] for f in range(3)])
    got = solve.solve_one("lasso", folds, (0.1, 1.0))
    means = [np.mean([c[2] for c in got["path"] if c[0] == a]) for a in (0.1, 1.0)]
    assert got["mse_min"] == min(c[2] for c in got["path"]) < min(means)


@pytest.mark.parametrize("m", [1, 3, 14, 62, 63, 64, 130])
def test_long_layout_round_trip(m):
    rng = np.random.default_rng(m)
    z = rng.normal(size=(50, m + 2))
    z[:, 0] = 1
    g = _Grams(z).under(rng.integers(0, 3, (6, 50)))
    table = _long(np.array([4, 9]), g.reshape(2, 3, m + 2, m + 2)).to_pandas()
    for s, seed in enumerate((4, 9)):
        for f in range(3):
            part = table[(table["seed"] == seed) & (table["fold"] == f)]
            assert np.allclose(unpack(part.sample(frac=1, random_state=1), m + 2), g[s * 3 + f],
                               rtol=1e-12, atol=1e-9)


@pytest.mark.parametrize("m", [3, 30])
def test_slabs_change_nothing(m, monkeypatch):
    from bootloom.operators import moments
    rng = np.random.default_rng(0)
    z, w = rng.normal(size=(500, m + 2)), rng.integers(0, 4, (5, 500))
    whole = moments._Grams(z).under(w)
    monkeypatch.setattr(moments, "SLAB", 700)
    assert np.allclose(moments._Grams(z).under(w), whole)
    assert np.allclose(whole[0], (z * w[0][:, None]).T @ z)


def test_design_centres_columns():
    x = np.array([[1.0, 10.0], [3.0, 20.0]])
    assert design(x, [2.0, 15.0]).tolist() == [[1, -1, -5], [1, 1, 5]]


def test_unknown_method():
    with pytest.raises(ValueError, match="unknown model"):
        solve.check_method("svr")
