"""Leading eigenpairs of one symmetric matrix: reflect to three diagonals, bisect, iterate back."""

from __future__ import annotations

import numpy as np


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder reflections: diagonal, the diagonal beside it, and Q with Q^T A Q tridiagonal."""
    a = np.array(matrix, np.float64)
    size = len(a)
    q = np.eye(size)
    for k in range(size - 2):
        x = a[k + 1:, k].copy()
        length = np.linalg.norm(x)
        if length == 0 or not np.any(x[1:]):
            continue
        x[0] += np.copysign(length, x[0])
        v = x / np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = a[k + 1, k] - 2 * v[0] * (v @ a[k + 1:, k])
        a[k + 2:, k] = a[k, k + 2:] = 0.0
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(diagonal: np.ndarray, beside: np.ndarray, value: float) -> int:
    """Sturm count: how many eigenvalues are less than ``value``."""
    tiny = np.finfo(np.float64).tiny
    count, pivot = 0, 1.0
    for k, entry in enumerate(diagonal.tolist()):
        square = float(beside[k - 1]) ** 2 if k else 0.0
        pivot = entry - value - (square / pivot if square else 0.0)
        if pivot == 0:
            pivot = -tiny if not square else -np.finfo(np.float64).eps * abs(float(beside[k - 1])) - tiny
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, beside: np.ndarray, count: int) -> list[float]:
    """The ``count`` largest eigenvalues, falling, by bisection until the bounds meet."""
    size = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], beside])) + np.abs(np.concatenate([beside, [0.0]]))
    least, most = float(np.min(diagonal - reach)), float(np.max(diagonal + reach))
    margin = 4 * np.finfo(np.float64).eps * max(abs(least), abs(most))
    out: list[float] = []
    for number in range(count):
        low, high = least - margin, (out[-1] if out else most) + margin
        while True:
            middle = low + (high - low) / 2
            if not low < middle < high:
                break
            # At most ``number`` eigenvalues are larger: the wanted one lies below.
            if size - below(diagonal, beside, middle) <= number:
                high = middle
            else:
                low = middle
        out.append(low)
    return out


def _solve(diagonal: np.ndarray, beside: np.ndarray, value: float, right: np.ndarray) -> np.ndarray:
    """(T - value I) x = right by elimination with row exchanges; a zero pivot becomes tiny."""
    size = len(diagonal)
    least = np.finfo(np.float64).eps * max(np.abs(diagonal).max(), np.abs(beside).max() if size > 1 else 0.0)
    main = (diagonal - value).tolist()
    first, second = [*beside.tolist(), 0.0], [0.0] * size
    x = right.tolist()
    for k in range(size - 1):
        low = float(beside[k])
        if abs(main[k]) >= abs(low):
            pivot = main[k] if abs(main[k]) > least else least
            main[k] = pivot
            factor = low / pivot
            main[k + 1] -= factor * first[k]
            x[k + 1] -= factor * x[k]
        else:
            factor = main[k] / low
            main[k], first_k = low, first[k]
            first[k] = main[k + 1]
            main[k + 1] = first_k - factor * first[k]
            second[k] = first[k + 1]
            first[k + 1] = -factor * second[k]
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
    for k in reversed(range(size)):
        pivot = main[k] if abs(main[k]) > least else least
        value = x[k]
        if k + 1 < size:
            value -= first[k] * x[k + 1]
        if k + 2 < size:
            value -= second[k] * x[k + 2]
        x[k] = value / pivot
        if abs(x[k]) > 1e200:  # only the direction counts
            x = [entry * 1e-200 for entry in x]
    return np.array(x)


def leading_vectors(diagonal: np.ndarray, beside: np.ndarray, values: list[float]) -> np.ndarray:
    """Unit eigenvectors as columns, by inverse iteration.

    A vector whose eigenvalue is close to earlier ones is made orthogonal to
    theirs in every round.
    """
    size = len(diagonal)
    norm = max(np.abs(diagonal).max(), np.abs(beside).max() if size > 1 else 0.0)
    vectors = np.zeros((size, len(values)))
    rng = np.random.default_rng(12)
    for number, value in enumerate(values):
        close = [n for n in range(number) if abs(values[n] - value) <= 1e-3 * norm]
        x = rng.standard_normal(size)
        for _ in range(6):
            x = _solve(diagonal, beside, value, x / np.linalg.norm(x))
            x /= np.abs(x).max()
            for _ in range(2):
                x -= vectors[:, close] @ (vectors[:, close].T @ x)
            if not np.any(x):
                x = rng.standard_normal(size)
        vectors[:, number] = x / np.linalg.norm(x)
    return vectors


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    count = min(count, len(matrix))
    scale = float(np.abs(matrix).max())
    if scale == 0:
        return np.zeros(count), np.eye(len(matrix), count)
    diagonal, beside, q = tridiagonal(matrix / scale)
    values = leading_values(diagonal, beside, count)
    vectors = q @ leading_vectors(diagonal, beside, values)
    return scale * np.array(values), vectors / np.linalg.norm(vectors, axis=0)
