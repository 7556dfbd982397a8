"""Sets of five-word shingles, as sorted 64-bit hashes, for whole Arrow batches of texts.

Words are runs of characters other than ASCII white space, A-Z lower-cased. A text with fewer than
five words has one shingle, all of its words; one without words has none.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WIDTH = 5
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; a bijection."""
    h = (h ^ (h >> np.uint64(32))) * _MULTIPLY
    h = (h ^ (h >> _SHIFT)) * _MULTIPLY
    return h ^ (h >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, word offsets of the texts)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    # lowered before the cast: on a slice that was cast, some versions of pyarrow lower other bytes
    texts = pc.fill_null(pc.ascii_lower(texts).cast(pa.large_string()), "")
    parts = pc.ascii_split_whitespace(texts)
    flat, rows = pc.list_flatten(parts), pc.list_parent_indices(parts).to_numpy()
    real = pc.greater(pc.binary_length(flat), 0)
    flat, rows = flat.filter(real), rows[real.to_numpy(zero_copy_only=False)]
    coded = flat.dictionary_encode()
    known = np.fromiter(
        (xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()),
        np.uint64, len(coded.dictionary),
    )
    hashes = known[coded.indices.to_numpy()] if len(flat) else np.zeros(0, np.uint64)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.bincount(rows, minlength=len(texts)), out=offsets[1:])
    return hashes, offsets


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, sorted and distinct within each text; offsets of the texts)."""
    words, offsets = word_hashes(texts)
    counts = np.diff(offsets)
    docs = len(counts)
    with np.errstate(over="ignore"):
        usable = max(len(words) - WIDTH + 1, 0)
        rolled = np.full(usable, np.uint64(WIDTH))
        for k in range(WIDTH):
            rolled = mix(rolled ^ words[k : k + usable]) if usable else rolled
        starts = np.ones(usable, bool)  # of shingles within one text
        for k in range(1, WIDTH):
            ends = offsets[1:] - k
            starts[ends[(ends >= 0) & (ends < usable)]] = False
        # a short text's start may lie behind the last full window, or before it in another text
        owner = np.repeat(np.arange(docs), counts)[:usable]
        starts &= counts[owner] >= WIDTH
        short = np.flatnonzero((counts > 0) & (counts < WIDTH))
        whole = np.zeros(len(short), np.uint64)
        for i, d in enumerate(short):
            h = np.array([counts[d]], np.uint64)
            for w in words[offsets[d] : offsets[d + 1]]:
                h = mix(h ^ w)
            whole[i] = h[0]
    values, owners = rolled[starts], owner[starts]
    bounds = np.searchsorted(owners, np.arange(docs + 1))
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            values[a:b].sort()
    first = np.ones(len(values), bool)
    if len(values) > 1:
        first[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[first], owners[first]
    if len(short):
        at = np.searchsorted(owners, short)
        values, owners = np.insert(values, at, whole), np.insert(owners, at, short)
    return values, np.searchsorted(owners, np.arange(docs + 1))
