"""Eigenvectors of a symmetric matrix by mixed-precision refinement.

Single-precision eigenvectors are corrected by matrix products in the platform's
long double (64 bits of mantissa on x86), after Ogita and Aishima: each step
doubles the number of right digits of all vectors whose eigenvalues are apart.
Eigenvalues that lie together get a sub-solve of their own.
"""

from __future__ import annotations

import numpy as np

LONG = np.longdouble
#: Steps shrink a turn by its square, so a few suffice; so do a few rounds of sub-solves.
_STEPS = 12
_ROUNDS = 4
#: Eigenvalues are apart if their gap is so many times what they may be wrong by; turns are
#: then small enough to be corrected by the next step.
_CLEAR = 1000


def _norm(a: np.ndarray) -> LONG:
    """The largest absolute row sum: no smaller than the spectral norm of a symmetric matrix."""
    return np.abs(a).sum(axis=1).max(initial=LONG(0))


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, LONG, LONG]:
    """Better vectors, the eigenvalues of ``x``, below which gap they count as one, and the largest turn."""
    r = np.eye(len(a), dtype=LONG) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    unsure = _CLEAR * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > unsure
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, unsure, np.abs(e).max(initial=LONG(0))


def _clusters(values: np.ndarray, unsure: LONG) -> list[np.ndarray]:
    """Groups of places whose eigenvalues can't be told apart one from the next."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > unsure) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def _vectors(a: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors as columns, in no order."""
    n = len(a)
    flat = a - np.eye(n, dtype=LONG) * (np.trace(a) / max(n, 1))
    largest = np.abs(flat).max(initial=LONG(0))
    if n < 2 or largest == 0 or not np.isfinite(largest):
        return np.eye(n, dtype=LONG)
    flat = flat / largest
    x = np.linalg.eigh(flat.astype(np.float32))[1].astype(LONG)
    for _ in range(_ROUNDS):
        before = LONG(np.inf)
        for _ in range(_STEPS):
            x, values, unsure, turn = _step(flat, x)
            if turn >= before / 2:
                break
            before = turn
        together = _clusters(values, unsure)
        for group in together:
            part = x[:, group].T @ (flat @ x[:, group])
            x[:, group] = x[:, group] @ _vectors((part + part.T) / 2)
        if not together or unsure <= 64 * _CLEAR * n * np.finfo(LONG).eps:  # equal as far as can be told: any basis will do
            break
    for _ in range(2):
        x = x + x @ (np.eye(n, dtype=LONG) - x.T @ x) / 2
    return x


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, both in long double.

    The sign makes each vector's entry of largest size positive (the first of equal ones).
    """
    a = np.asarray(a, LONG)
    a = (a + a.T) / 2
    x = _vectors(a)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    if len(a):
        x = x * np.sign(x[np.abs(x).argmax(axis=0), np.arange(x.shape[1])])
    return values[order], x
