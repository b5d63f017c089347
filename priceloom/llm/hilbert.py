"""Approximate nearest neighbours by shifted Hilbert curves over projected vectors."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer ``cells`` (n x d, ``bits`` bits each, d * bits <= 62), as int64.

    Gray-code transposition: the axes are folded bit by bit from the top, then the bits are interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p, qq = np.uint64(q - 1), np.uint64(q)
        for i in range(d):
            on = (x[i] & qq) != 0
            t = (x[0] ^ x[i]) & p
            x[0] ^= np.where(on, p, t)
            if i:
                x[i] ^= np.where(on, np.uint64(0), t)
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[d - 1] & np.uint64(q)) != 0, np.uint64(q - 1), np.uint64(0))
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


def fit_curves(sample: np.ndarray, curves: int, dims: int, seed: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per curve: projection directions (drawn with the sample's covariance, so that they follow the data), the quantiles of each projected
    coordinate, and a random shift."""
    rng = np.random.default_rng(seed)
    centred = sample - sample.mean(0)
    out = []
    for _ in range(curves):
        # Random mixtures of sample rows have the sample's covariance; a little isotropic noise keeps full rank.
        mixed = rng.normal(size=(dims, len(sample))) @ centred / max(1.0, len(sample) ** 0.5) + 1e-3 * rng.normal(size=(dims, sample.shape[1]))
        axes = np.linalg.qr(mixed.T)[0][:, :dims]
        marks = np.quantile(sample @ axes, np.linspace(0, 1, 257), axis=0)
        out.append((axes, marks, rng.uniform(0, 0.1, axes.shape[1])))
    return out


def curve_keys(x: np.ndarray, curve: tuple, bits: int) -> np.ndarray:
    """Keys of unit vectors on one shifted curve; a coordinate is placed by its quantile in the sample."""
    axes, marks, shift = curve
    z = x @ axes
    u = np.stack([np.interp(z[:, i], marks[:, i], np.linspace(0, 0.9, len(marks))) for i in range(z.shape[1])], 1) + shift
    return hilbert_keys((u * (1 << bits)).astype(np.int64), bits)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; the same pair gives the same double wherever it is computed."""
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
