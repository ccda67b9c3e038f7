"""Hashed character features, and linear models over them that run inside tasks."""

import re

import numpy as np

NOT_LETTERS = re.compile(r"[\W\d_]+")
CHUNK = 1 << 18
MIX = np.uint32(2654435761)


def grams(text: str, bits: int, orders=(1, 2, 3), letters: bool = True) -> np.ndarray:
    """Counts of a text's character n-grams in 2**bits cells; long texts are read in overlapping chunks."""
    if letters:
        text = f" {NOT_LETTERS.sub(' ', text.lower()).strip()} "
    cells = np.zeros(1 << bits, np.float64)
    for start in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[start : start + CHUNK + max(orders) - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        own = min(CHUNK, len(text) - start)
        for n in orders:
            count = min(own, len(codes) - n + 1)
            if count <= 0:
                continue
            mixed = codes[:count] + np.uint32(n * 7919)
            for i in range(1, n):
                mixed = (mixed ^ (mixed >> np.uint32(15))) * MIX + codes[i : i + count]
            mixed = (mixed ^ (mixed >> np.uint32(16))) * MIX
            cells += np.bincount(mixed >> np.uint32(32 - bits), minlength=1 << bits)
    return cells


def unit(cells: np.ndarray) -> np.ndarray:
    """Roots of the counts, at length 1: frequent n-grams do not drown the others."""
    total = cells.sum()
    return np.sqrt(cells / total).astype(np.float32) if total else cells.astype(np.float32)


def linear_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, rounds: int = 30, seed: int = 7) -> np.ndarray:
    """Weights (bias last) of a linear support vector machine, classes +1 and -1, by dual coordinate descent
    on the squared hinge loss. Classes count alike, whatever their size."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    cost = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum()))) * c
    square = (x * x).sum(1) + 0.5 / cost
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1 + 0.5 / cost[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / square[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


def logistic(x: np.ndarray, p: np.ndarray, l2: float = 1e-3, rounds: int = 60, rate: float = 2.0) -> np.ndarray:
    """Weights (bias last) of a logistic model fitted to probabilities ``p``, by accelerated gradient
    descent; both classes weigh alike."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    share = p * (0.5 / max(1e-9, p.mean())) + (1 - p) * (0.5 / max(1e-9, (1 - p).mean()))
    w = ahead = np.zeros(x.shape[1])
    for k in range(rounds):
        z = 1 / (1 + np.exp(-np.clip(x @ ahead, -40, 40)))
        after = ahead - rate * (x.T @ (share * (z - p)) / len(x) + l2 * ahead)
        ahead = after + k / (k + 3) * (after - w)
        w = after
    return w
