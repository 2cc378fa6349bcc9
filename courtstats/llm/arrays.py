"""Texts of an Arrow batch as numpy arrays, and hashes of their words.

Everything here works on bytes of UTF-8. A word is a run of bytes other than
space, tab, line feed, vertical tab, form feed and carriage return.
"""

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Hashes of slices are polynomials modulo this prime.
_PRIME = (1 << 61) - 1
_BASE = 0x1E3779B97F4A7C15 % _PRIME
_BASE_INVERSE = pow(_BASE, -1, _PRIME)
_HALF, _HALF_BITS = np.uint64((1 << 31) - 1), np.uint64(31)
_powers = {}


def mix(x):
    """A permutation of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _reduced(x):
    x = (x & np.uint64(_PRIME)) + (x >> np.uint64(61))
    return np.where(x >= _PRIME, x - np.uint64(_PRIME), x)


def _times(a, b):
    """Products of numbers below the prime, modulo the prime."""
    high, low, other, less = a >> _HALF_BITS, a & _HALF, b >> _HALF_BITS, b & _HALF
    middle = high * less + low * other
    return _reduced(
        np.uint64(2) * high * other
        + (middle >> np.uint64(30))
        + ((middle & np.uint64((1 << 30) - 1)) << _HALF_BITS)
        + low * less
    )


def _powers_of(base, n):
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.ones(1, np.uint64)
        while len(have) < max(n, 1 << 16):
            more = _times(have, np.uint64(pow(base, len(have), _PRIME)))
            have = np.concatenate([have, more])
        if n <= 1 << 23:
            _powers[base] = have
    return have[:n]


class Prefixes:
    """Polynomial prefix hashes of numbers: the hash of any slice in one step.

    The modulus is a prime, so no regular text cancels out; sums are kept in two
    halves of 31 bits.
    """

    def __init__(self, data):
        n = len(data)
        power = _powers_of(_BASE, n)
        value = data.astype(np.uint64)
        small = data.dtype.itemsize < 8 and n * (int(data.max(initial=0)) + 1) < 1 << 32
        value = value + np.uint64(1) if data.dtype.itemsize < 8 else _reduced(value)
        if small:
            low, high = (power & _HALF) * value, (power >> _HALF_BITS) * value
        else:
            product = _times(power, value)
            low, high = product & _HALF, product >> _HALF_BITS
        self.low, self.high = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
        np.cumsum(low, out=self.low[1:])
        np.cumsum(high, out=self.high[1:])
        self.down = _powers_of(_BASE_INVERSE, n + 1)

    def of(self, starts, ends):
        ends = np.asarray(ends)
        low, high = self.low[ends] - self.low[starts], self.high[ends] - self.high[starts]
        span = _reduced(_times(_reduced(high), np.uint64(1 << 31)) + _reduced(low))
        span = _times(span, self.down[starts])
        return mix(span ^ ((ends - starts).astype(np.uint64) << np.uint64(48)))


def bytes_of(column):
    """The bytes of a text column and where each row begins (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string() if _is_text(column) else pa.large_binary())
    if column.null_count:
        column = column.fill_null("" if _is_text(column) else b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(column) else data, offsets - offsets[0]


def _is_text(column):
    return pa.types.is_string(column.type) or pa.types.is_large_string(column.type)


#: Texts are worked on in slices whose arrays stay in the cache.
SLICE_BYTES = 1 << 17
#: For work that looks every different word of a slice up once.
LARGE_SLICE_BYTES = 1 << 20


def slices(offsets, most=SLICE_BYTES):
    """Ranges of rows with about ``most`` bytes; a longer text stands alone."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield row, end
        row = end


def word_spans(data, offsets):
    """Starts and ends of words, and the number of words of each row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets) - 1, np.int64)
    space = _SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = True
    before[1:] = space[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(~space & before)
    after = np.empty(len(data), bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data, offsets):
    """A 64-bit hash of each word, A-Z in lower case, and words of each row."""
    starts, ends, counts = word_spans(data, offsets)
    return Prefixes(_LOWER[data]).of(starts, ends), counts


def shingle_hashes(words, counts, size):
    """Hashes of ``size`` words in a row, and how many each row has.

    A row with fewer words has one, of all its words; without words none.
    """
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    ends = np.cumsum(counts)
    begins = ends - counts
    have = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    total = np.zeros(len(words), np.uint64)
    for j in range(min(size, len(words))):
        total[: len(words) - j] += words[j:] * factors[j]
    at = np.repeat(begins - (np.cumsum(have) - have), have) + np.arange(have.sum())
    out = total[at]
    first = np.cumsum(have) - have
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        n = int(counts[row])
        own = words[begins[row] : begins[row] + n] * factors[:n]
        out[first[row]] = own.sum(dtype=np.uint64) ^ np.uint64(n)
    return mix(out), have


def pieces(column, most=SLICE_BYTES):
    """Slices of a text column small enough to work on: rows, bytes, offsets."""
    data, offsets = bytes_of(column)
    for begin, end in slices(offsets, most):
        yield (
            begin,
            end,
            data[offsets[begin] : offsets[end]],
            offsets[begin : end + 1] - offsets[begin],
        )


#: What a task puts into one batch of rows that it makes.
BATCH_BYTES = 4 << 20


def in_batches(names, types, rows, size, most=None):
    """Batches of about ``most`` bytes from rows, of whose bytes ``size`` tells.

    What a task holds is bounded however many rows come from one batch of input.
    """
    held, total = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    for row in rows:
        held.append(row)
        total += size(row)
        if total > (most or BATCH_BYTES):
            yield batch()
            held, total = [], 0
    if held:
        yield batch()
