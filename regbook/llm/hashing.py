"""Vectorised 64-bit hashes of every gram of a sequence."""

from __future__ import annotations

import numpy as np

SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of every number; a bijection."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def refine(buckets: np.ndarray, have: int, want: int) -> np.ndarray:
    """Hashes of ``want`` neighbours from those of ``have``, doubling while it fits."""
    while have < want:
        step = min(have, want - have)
        buckets = mix(buckets[:-step] * np.uint64(0xFF51AFD7ED558CCD) + buckets[step:])
        have += step
    return buckets
