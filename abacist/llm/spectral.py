"""Leading eigenvectors of a symmetric matrix by polar decompositions.

The polar factor of a shifted matrix has eigenvalue 1 above the shift and -1
below it, which gives the projector on everything above. Its range and the rest
are invariant, so the matrix falls into two smaller ones, and so on. Polar factors
come from the dynamically weighted Halley iteration in its QR form.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

EPSILON = np.finfo(np.float64).eps

ROUNDS = 60
"""Halley steps at most; six are enough unless an eigenvalue all but equals the shift."""


def polar_factor(matrix: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix: its eigenvalues become their signs."""
    size = len(matrix)
    eye = np.eye(size)
    x, low = matrix / np.linalg.norm(matrix), EPSILON / size
    for _ in range(ROUNDS):
        low2 = low * low
        d = np.cbrt(4 * (1 - low2) / (low2 * low2))
        root = np.sqrt(1 + d)
        a = root + np.sqrt(8 - 4 * d + 8 * (2 - low2) / (low2 * root)) / 2
        b = (a - 1) ** 2 / 4
        c = a + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack((np.sqrt(c) * x, eye)))
            new = b / c * x + (a - b / c) / np.sqrt(c) * (q[:size] @ q[size:].T)
        else:
            new = b / c * x + (a - b / c) * np.linalg.solve(eye + c * (x @ x), x)
        new = (new + new.T) / 2
        low = min(1.0, low * (a + b * low2) / (1 + c * low2))
        moved, x = np.linalg.norm(new - x), new
        if moved <= 10 * EPSILON * size:
            break
    return x


def _shifts(matrix: np.ndarray) -> Iterator[float]:
    """Places inside the spectrum to cut at, the likeliest to halve it first."""
    diagonal = np.diagonal(matrix)
    mean = float(diagonal.mean())
    deviation = float(np.linalg.norm(matrix - mean * np.eye(len(matrix)))) / np.sqrt(len(matrix))
    yield float(np.median(diagonal))
    yield mean
    for part in (0.5, 0.25, 0.75, 0.125, 0.375, 0.0625):
        yield mean + part * deviation
        yield mean - part * deviation


def _divided(matrix: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the upper and the lower part of the spectrum; None for a multiple of the identity."""
    size = len(matrix)
    eye = np.eye(size)
    if np.linalg.norm(matrix - np.diagonal(matrix).mean() * eye) <= 4 * EPSILON * size * scale:
        return None
    draws = np.random.default_rng(size)
    for shift in _shifts(matrix):
        shifted = matrix - shift * eye
        if not np.linalg.norm(shifted):
            continue
        factor = polar_factor(shifted)
        upper = int(round((np.trace(factor) + size) / 2))
        if not 0 < upper < size or np.linalg.norm(factor @ factor - eye) > 1e-9 * size:
            continue
        parts = []
        for projector, rank in (((eye + factor) / 2, upper), ((eye - factor) / 2, size - upper)):
            basis, _ = np.linalg.qr(projector @ draws.normal(size=(size, rank)))
            basis, _ = np.linalg.qr(projector @ basis)
            parts.append(basis)
        both, _ = np.linalg.qr(np.hstack(parts))
        above, below = both[:, :upper], both[:, upper:]
        if np.linalg.norm(above.T @ matrix @ below) <= 64 * EPSILON * size * scale:
            return above, below
    raise ArithmeticError("no shift divides the spectrum")


def leading_components(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues, falling, and their unit eigenvectors as rows.

    The upper part of every cut is divided first, so parts that hold only smaller
    eigenvalues are never looked into.
    """
    size = len(matrix)
    matrix = (matrix + matrix.T) / 2
    scale = float(np.linalg.norm(matrix))
    found: list[np.ndarray] = []
    waiting = [np.eye(size)]
    while waiting and len(found) < count:
        basis = waiting.pop()
        inner = basis.T @ matrix @ basis
        parts = _divided((inner + inner.T) / 2, scale) if len(inner) > 1 else None
        if parts is None:
            found.extend(basis.T)
        else:
            waiting += [basis @ parts[1], basis @ parts[0]]
    vectors = np.array(found[:count]).reshape(-1, size)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    values = np.einsum("kd,de,ke->k", vectors, matrix, vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[order]
