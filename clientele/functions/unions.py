"""Disjoint sets of array positions, merged for many links at once."""

from __future__ import annotations

import numpy as np


def unite(label: np.ndarray, one: np.ndarray, other: np.ndarray) -> None:
    """Merge, in place, the sets of each linked pair; every position points to its set's least."""
    while len(one):
        a, b = label[one], label[other]
        apart = a != b
        if not apart.any():
            return
        one, other, a, b = one[apart], other[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label[:] = label[label]
