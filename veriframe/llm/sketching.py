"""Fast similarity sketches: MinHash values for all bins from few passes over a set.

In round r each element is placed in a bin by its hash of that round, with a value of (r, the rest of the hash); a bin keeps its least value,
so what an earlier round has put there stays. Rounds end as soon as all bins are filled: one or two for sets much larger than the number of
bins, more for small ones. After ``BINS`` such rounds each bin still empty gets a round of its own, in which all elements are placed there, so
every bin is filled, whatever the set. Two sets agree in a bin with the probability of their Jaccard similarity, and the number of
bins in which they agree is as concentrated as with independent hash functions.

``ROWS`` bins make a band. Sets of similarity s share one of ``BANDS`` bands or more with probability 1 - (1 - s ** ROWS) ** BANDS:
0.999993 at 0.8, 0.99999998 at 0.85.
"""

from __future__ import annotations

import numpy as np
import xxhash

BANDS, ROWS = 30, 5
BINS = BANDS * ROWS
SEEDS = np.random.default_rng(12).integers(0, 1 << 63, 2 * BINS, np.uint64)
EMPTY = ~np.uint64(0)
#: Elements times rounds that are hashed at once.
AT_ONCE = 1 << 13


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finalizer of the public SplitMix generator; its shifts and factors are fixed values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sketch(elements: np.ndarray) -> np.ndarray:
    """The least value of each bin. elements: a set's distinct 64-bit hashes, one at least."""
    least, word = np.full(BINS, EMPTY), np.uint64(32)
    step = max(1, AT_ONCE // len(elements))
    for first in range(0, BINS, step):
        rounds = np.arange(first, min(first + step, BINS))
        for at in range(0, len(elements), AT_ONCE):  # so that a very long text needs little memory
            hashes = mixed(elements[None, at : at + AT_ONCE] ^ SEEDS[rounds, None])
            bins = ((hashes >> word) * np.uint64(BINS)) >> word
            values = (rounds.astype(np.uint64)[:, None] << word) | (hashes & np.uint64(0xFFFFFFFF))
            np.minimum.at(least, bins.ravel().astype(np.int64), values.ravel())
        if (least != EMPTY).all():
            return least
    for k in np.flatnonzero(least == EMPTY).tolist():
        least[k] = (np.uint64(BINS + k) << word) | (mixed(elements ^ SEEDS[BINS + k]) & np.uint64(0xFFFFFFFF)).min()
    return least


def band_keys(elements: np.ndarray) -> list[int]:
    """The keys of a set: one signed long a band."""
    keys = [xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(sketch(elements).reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()
