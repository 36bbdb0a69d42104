"""Logistic regression on hashed features, fitted on a bounded sample."""

from __future__ import annotations

import numpy as np


def fit(row: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray, size: int, rounds: int = 60, ridge: float = 1e-4):
    """Weights and intercept for targets from 0 to 1, by full gradients with a step size for each weight.

    (row, feature, value) are the entries of a sparse matrix.
    """
    weight, seen = np.zeros(size), np.full(size, 1e-8)
    bias, bias_seen, n = 0.0, 1e-8, max(1, len(target))
    for _ in range(rounds):
        error = chance(score(row, feature, value, weight, bias, len(target))) - target
        slope = np.bincount(feature, error[row] * value, minlength=size) / n + ridge * weight
        seen += slope**2
        weight -= 0.5 * slope / np.sqrt(seen)
        bias_seen += error.mean() ** 2
        bias -= 0.5 * error.mean() / np.sqrt(bias_seen)
    return weight, bias


def score(row, feature, value, weight, bias, n) -> np.ndarray:
    return np.bincount(row, weight[feature] * value, minlength=n) + bias


def chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def hashed_grams(texts: list[bytes], sizes: tuple[int, ...], buckets: int):
    """(row, bucket, share): for each text how much of its byte n-grams falls in each bucket."""
    from meterline.llm.words import mix

    raw = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    keys = []
    for n in sizes:
        if len(raw) < n:
            continue
        code = np.full(len(raw) - n + 1, n, np.uint64)
        for j in range(n):
            code = code << np.uint64(8) | raw[j : len(raw) - n + 1 + j]
        inside = doc[: len(code)] == doc[n - 1 :]
        keys.append(doc[: len(code)][inside] * buckets + (mix(code[inside]) % np.uint64(buckets)).astype(np.int64))
    key, count = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
    row = key // buckets
    total = np.bincount(row, count, minlength=len(texts))
    # lengths of rows are made alike, so that long and short texts weigh the same
    norm = np.sqrt(np.bincount(row, np.log1p(count) ** 2, minlength=len(texts)))
    return row, key % buckets, np.log1p(count) / np.where(total > 0, norm, 1)[row]
