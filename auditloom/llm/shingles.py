r"""Word shingles of texts as sorted 64-bit hashes, computed for whole Arrow batches.

A-Z are lowered and words are `[^\x20\x09-\x0D]+`. A text's set holds its
distinct shingles of `SIZE` words; a text of fewer words has its whole sequence
as the only shingle; one without words has an empty set.

Everything is done on the bytes of a batch at once: a word's hash is a
difference of running sums of byte values times powers of an odd number modulo
2^64, mixed, and a shingle's is the mixed sum of its words' times powers of
another.
"""

import numpy as np
import pyarrow as pa

SIZE = 5

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F


def mixed(x):
    """Each 64-bit number with its bits spread; different numbers stay different."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base, count):
    """`base` to the powers 0 to count - 1, modulo 2^64."""
    out = np.empty(max(count, 1), np.uint64)
    out[0] = 1
    have = 1
    step = base % 2**64
    while have < count:
        take = min(have, count - have)
        np.multiply(out[:take], np.uint64(step), out=out[have : have + take])
        have += take
        step = step * step % 2**64
    return out


def _lowered():
    table = np.arange(256, dtype=np.uint64)
    table[65:91] += 32
    return table + np.uint64(1)


def word_hashes(texts):
    """(hash of each word, number of the first word of each text and one past the last).

    `texts` is an Arrow string array; nulls have no words.
    """
    if pa.types.is_large_string(texts.type):
        offset_type = np.int64
    else:
        texts, offset_type = texts.cast(pa.string()), np.int32
    size = len(texts)
    _, offsets, data = texts.buffers()
    if size == 0 or data is None:
        return np.empty(0, np.uint64), np.zeros(size + 1, np.int64)
    ends = np.frombuffer(offsets, offset_type, size + 1, texts.offset * np.dtype(offset_type).itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, int(ends[-1] - ends[0]), int(ends[0]))
    ends = ends - ends[0]
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    # A word begins at a letter that has a blank or the text's begin in front.
    first = ~blank
    begins = first.copy()
    begins[1:] &= blank[:-1]
    starts_of_text = ends[:-1][ends[:-1] < len(raw)]
    begins[starts_of_text] = first[starts_of_text]
    start = np.flatnonzero(begins)
    if len(start) == 0:
        return np.empty(0, np.uint64), np.zeros(size + 1, np.int64)
    # It ends in front of the next blank or text.
    stops = np.flatnonzero(blank)
    bounds = np.unique(np.concatenate([stops, ends]))
    stop = bounds[np.searchsorted(bounds, start, side="right")]
    # Positions count from the word's begin: no power grows with the batch.
    values = _lowered()[raw]
    lengths = stop - start
    longest = int(lengths.max())
    powers = _powers(_BYTE_BASE, longest)
    place = np.zeros(len(raw), np.int32)
    place[start[0] :] = np.arange(len(raw) - start[0], dtype=np.int32)
    place[start[0] :] -= np.repeat((start - start[0]).astype(np.int32), np.diff(np.append(start, len(raw))))
    values[blank] = 0
    np.minimum(place, longest - 1, out=place)
    values *= powers[place]
    sums = np.add.reduceat(values, start)
    hashes = mixed(sums ^ (lengths.astype(np.uint64) << np.uint64(40)))
    return hashes, np.searchsorted(start, ends).astype(np.int64)


def shingle_sets(texts):
    """The sorted distinct shingle hashes of each text, as a list of arrays."""
    words, bounds = word_hashes(texts)
    weights = [np.uint64(pow(_WORD_BASE, k, 2**64)) for k in range(SIZE)]
    whole = np.empty(0, np.uint64)
    if len(words) >= SIZE:
        whole = np.zeros(len(words) - SIZE + 1, np.uint64)
        for k in range(SIZE):
            whole += words[k : len(words) - SIZE + 1 + k] * weights[k]
        whole = mixed(whole)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= SIZE:
            out.append(np.unique(whole[a : b - SIZE + 1]))
        elif b > a:
            short = (words[a:b] * np.array(weights[: b - a])).sum(dtype=np.uint64, keepdims=True)
            out.append(mixed(short + np.uint64(b - a)))
        else:
            out.append(whole[:0])
    return out
