"""Words and word shingles of a column of whole texts, as 64-bit hashes, inside a task.

Words are runs of anything but the six ASCII blanks (space and U+0009 to U+000D), with A-Z lower-cased. A null text has
no words. Hashes stand for words and shingles: two differ by chance only (one in 2**64 for a pair).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finisher of splitmix64, whose two factors are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def odd_factors(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit factors drawn from ``seed``."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) | np.uint64(1)


def as_text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column as one array with 64-bit offsets and "" for null.

    A slice is copied first: Arrow's kernels below misread the offsets of a sliced array.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.offset:
        column = column.take(pa.array(np.arange(len(column))))
    return pc.fill_null(column, "").cast(pa.large_string())


def words_of(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Bounds of each text's words, the distinct words, and the index of every word among them."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat, offsets = parts.flatten(), parts.offsets.to_numpy()
    offsets = offsets - offsets[0]
    full = pc.not_equal(flat, "")
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    coded = flat.filter(full).dictionary_encode()
    return kept[offsets], coded.dictionary, coded.indices.to_numpy()


def hash_words(texts: pa.Array, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of each text's words, and the hash of every word; each distinct word is hashed once."""
    bounds, distinct, index = words_of(texts)
    table = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in distinct.to_pylist()), np.uint64, len(distinct))
    return bounds, table[index] if len(distinct) else np.zeros(0, np.uint64)


def hash_shingles(texts: pa.Array, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Bounds and hashes of each text's runs of ``width`` words, in order, repeats included.

    A text of fewer words has its whole sequence as the one shingle; a text without words has none.
    """
    bounds, words = hash_words(texts, seed)
    factors = odd_factors(width, seed + 1)
    n = np.diff(bounds)
    total = np.zeros(len(words), np.uint64)
    short = (n > 0) & (n < width)
    for k in range(width):
        if k < len(words):
            total[: len(words) - k] += words[k:] * factors[k]
    inside = np.ones(len(words), bool)
    for k in range(1, width):  # a start this near to its text's end has no full run
        last = bounds[1:][n >= k] - k
        inside[last] = False
    first = bounds[:-1][short]
    for at, length in zip(first.tolist(), n[short].tolist(), strict=True):
        total[at] = (words[at : at + length] * factors[:length]).sum(dtype=np.uint64) + np.uint64(length)
    inside[first] = True
    counts = np.concatenate([[0], np.cumsum(inside)])
    return counts[bounds], mix(total[inside])


def distinct_sets(bounds: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted, without repeats."""
    sets = [np.unique(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    return np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(sets) if sets else np.zeros(0, np.uint64)
