"""The plain way, on gathered rows in NumPy: what every distributed path must agree with."""

import numpy as np


def least_squares(x, y):
    """Shortest least-squares coefficients with an intercept."""
    xc, yc = x - x.mean(axis=0), y - y.mean()
    b = np.linalg.lstsq(xc, yc, rcond=1e-10)[0]
    return b, y.mean() - x.mean(axis=0) @ b


def ridge(x, y, alpha):
    xc, yc = x - x.mean(axis=0), y - y.mean()
    b = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return b, y.mean() - x.mean(axis=0) @ b


def lasso(x, y, alpha, sweeps=20000):
    """Coordinate descent on the residuals of the gathered rows."""
    xc, yc = x - x.mean(axis=0), y - y.mean()
    n, b, left = len(y), np.zeros(x.shape[1]), yc.copy()
    size = (xc ** 2).sum(axis=0)
    for _ in range(sweeps):
        step = 0.0
        for j in range(x.shape[1]):
            if size[j] <= 1e-12 * max((x[:, j] ** 2).sum(), 1e-300):
                continue
            rho = xc[:, j] @ left + size[j] * b[j]
            new = np.sign(rho) * max(abs(rho) - n * alpha, 0.0) / size[j]
            left -= xc[:, j] * (new - b[j])
            step = max(step, abs(new - b[j]) * np.sqrt(size[j]))
            b[j] = new
        if step <= 1e-13 * np.sqrt((yc ** 2).sum()):
            break
    return b, y.mean() - x.mean(axis=0) @ b


def fit(method, x, y, alpha):
    return {"linear": lambda: least_squares(x, y), "ridge": lambda: ridge(x, y, alpha),
            "lasso": lambda: lasso(x, y, alpha)}[method]()


def r2(y, p):
    return 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum()


def cross_validated(method, x, y, fold, alphas):
    """(alpha, coef, intercept, in-sample r2, path) of one resample with its fold numbers."""
    path, alpha = {}, None
    for a in alphas:
        for f in np.unique(fold):
            b, b0 = fit(method, x[fold != f], y[fold != f], a)
            p = x[fold == f] @ b + b0
            path[a, f] = (np.mean((y[fold == f] - p) ** 2), r2(y[fold == f], p))
    if method == "lasso":
        alpha = min(sorted(alphas, reverse=True),
                    key=lambda a: np.mean([v[0] for (c, _), v in path.items() if c == a]))
    elif method == "ridge":
        alpha = max(alphas, key=lambda a: np.mean([v[1] for (c, _), v in path.items() if c == a]))
    b, b0 = fit(method, x, y, alpha)
    return alpha, b, b0, r2(y, x @ b + b0), path
