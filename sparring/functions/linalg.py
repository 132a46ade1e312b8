"""Driver-side algebra on bounded matrices."""

from __future__ import annotations

import numpy as np


def top_eigenvectors(gram: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors (as columns) from a Gram matrix.

    Signs are fixed by making the largest loading of every vector positive.
    """
    values, vectors = np.linalg.eigh(gram)
    order = np.argsort(values)[::-1][:k]
    return np.sqrt(np.maximum(values[order], 0.0)), fix_signs(vectors[:, order])


def fix_signs(vectors: np.ndarray) -> np.ndarray:
    biggest = np.abs(vectors).argmax(axis=0)
    signs = np.sign(vectors[biggest, np.arange(vectors.shape[1])])
    return vectors * np.where(signs == 0, 1.0, signs)
