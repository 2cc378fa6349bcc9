"""Suffix arrays by induced sorting, and permuted common prefixes, with numpy.

Symbols of ``text`` are 1..254; a virtual 0 stands behind the end.
"""

import numpy as np

PAD = 255


def _rising(text):
    """True where a suffix is smaller than its right neighbour (S type)."""
    if not len(text):
        return np.zeros(0, bool)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), len(text) - 1)
    up = np.append(text[ends[:-1]] < text[ends[:-1] + 1], False)
    return np.repeat(up, np.diff(ends, prepend=-1))


def _names(text, starts, ends, bits):
    """Dense ranks of ``text[start..end]``, the end included.

    If one is the beginning of another, the shorter is the greater: its last
    symbol begins a rising suffix, the same symbol inside the longer a falling one.
    The symbol behind the end of the text is 0.
    """
    each = 63 // bits
    pad = np.uint64((1 << bits) - 1)
    rank = np.zeros(len(starts), np.int64)
    symbols = np.append(text, 0).astype(np.uint64)
    rows, at = np.arange(len(starts)), 0
    while len(rows):
        begin = starts[rows] + at
        left = ends[rows] - begin + 1
        key = np.zeros(len(rows), np.uint64)
        for k in range(each):
            symbol = symbols[np.minimum(begin + k, len(text))]
            symbol[left <= k] = pad
            key <<= np.uint64(bits)
            key |= symbol
        # At first all have one rank.
        order = np.lexsort((key, rank[rows])) if at else np.argsort(key, kind="stable")
        old, key = rank[rows][order], key[order]
        new_group = np.append(True, old[1:] != old[:-1])
        new = new_group | np.append(True, key[1:] != key[:-1])
        # A rank that falls apart moves all greater ranks up.
        parts = np.zeros(int(rank.max()) + 2, np.int64)
        np.add.at(parts, old[new & ~new_group] + 1, 1)
        moved = np.cumsum(parts)
        within = np.cumsum(new) - 1
        within -= np.maximum.accumulate(np.where(new_group, within, 0))
        rank += moved[rank]
        rank[rows[order]] += within
        at += each
        more = (ends - starts + 1) > at
        if not more.any():
            return rank
        unsure = np.zeros(int(rank.max()) + 1, bool)
        unsure[rank[more]] = True
        several = np.bincount(rank) > 1
        rows = np.flatnonzero((unsure & several)[rank])
    return rank


def _smallest(text):
    """Positions where falling turns to rising: leftmost smaller (LMS) suffixes."""
    up = _rising(text)
    return np.flatnonzero(up[1:] & ~up[:-1]) + 1, up


def _ranks(text, bits):
    """The rank of every suffix of a string of names.

    The smallest suffixes are ranked by a further level; all others are induced by
    one sort on (symbols up to the next of them, its rank). Alphabets of names are
    too large for passes by bucket.
    """
    at, _ = _smallest(text)
    following = np.append(at, len(text))
    place = np.searchsorted(at, np.arange(len(text)), "right")
    names = _names(text, np.arange(len(text)), following[place], bits)
    order_of_next = np.append(_order(names[at]) + 1 if len(at) else [], 0).astype(np.int64)
    order = np.lexsort((order_of_next[place], names))
    rank = np.empty(len(text), np.int64)
    rank[order] = np.arange(len(text))
    return rank


def _order(names):
    """Ranks of the suffixes of a sequence of names."""
    if len(np.unique(names)) == len(names):
        return np.argsort(np.argsort(names))
    values = np.unique(names, return_inverse=True)[1] + 1
    return _ranks(values, int(values.max() + 1).bit_length())


def suffix_array(text):
    """The order of all suffixes of an array of bytes between 1 and 254."""
    n = len(text)
    if n == 0:
        return np.zeros(0, np.int64)
    smallest, up = _smallest(text)
    if len(smallest):
        names = _names(text, smallest, np.append(smallest[1:], n), 8)
        smallest = smallest[np.argsort(_order(names))]
    return _induced(text, up, smallest)


def _induced(text, up, smallest):
    """All suffixes from the sorted leftmost smaller ones, in two linear passes.

    A pass walks over the buckets of first symbols. All suffixes of a bucket that
    are known put their left neighbours into place at once; those of the same
    symbol are the next round of the bucket.
    """
    n = len(text)
    size = np.bincount(text, minlength=256)
    begins = np.cumsum(size) - size
    out = np.zeros(n, np.int64)
    first = text[smallest]
    cut = np.searchsorted(first, np.arange(257))
    head, tail = begins.copy(), begins + size

    def put(found, back):
        symbols = text[found]
        order = np.argsort(symbols, kind="stable")
        found, symbols = found[order], symbols[order]
        counts = np.bincount(symbols, minlength=256)
        step = np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts)
        if back:
            out[tail[symbols] - 1 - step] = found
            np.subtract(tail, counts, out=tail)
        else:
            out[head[symbols] + step] = found
            np.add(head, counts, out=head)

    def left_of(known):
        return known[known > 0] - 1

    put(np.array([n - 1]), False)
    used = np.flatnonzero(size)
    for c in used:
        done = begins[c]
        while done < head[c]:
            known = left_of(out[done : head[c]])
            done = head[c]
            put(known[text[known] >= c], False)
        put(left_of(smallest[cut[c] : cut[c + 1]]), False)
    falling = head.copy()
    for c in used[::-1]:
        done = begins[c] + size[c]
        while done > tail[c]:
            known = left_of(out[tail[c] : done][::-1])
            done = tail[c]
            put(known[text[known] <= c], True)
        known = left_of(out[begins[c] : falling[c]][::-1])
        put(known[text[known] < c], True)
    return out


def permuted_common_prefixes(text, order, most):
    """For each position, bytes shared with the suffix before it in ``order``.

    Counted up to ``most``. Only where the bytes to the left differ is anything
    compared; from there each next position shares one byte less.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    here = np.arange(n)
    same_left = (before > 0) & (here > 0)
    same_left &= text[here - 1] == text[np.maximum(before, 1) - 1]
    start = np.flatnonzero(~same_left)
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    word = np.zeros(n + most + 8, np.uint64)
    for k in range(8):
        word |= padded[k : k + len(word)].astype(np.uint64) << np.uint64(8 * k)
    shared = np.zeros(n, np.int64)
    live = start[before[start] >= 0]
    at = 0
    while len(live) and at < most:
        differ = word[live + at] ^ word[before[live] + at]
        ended = differ != 0
        low = differ[ended] & (~differ[ended] + np.uint64(1))
        shared[live[ended]] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        live = live[~ended]
        at += 8
    shared[live] = most
    # Reducible positions: one less than the position to the left. A capped value
    # stays capped only if compared again, so those are settled on their own.
    shared = _carried(shared, ~same_left, word, before, most)
    return np.minimum(shared, np.minimum(n - here, n - before))


def _carried(shared, begins, word, before, most):
    n = len(shared)
    if not n:
        return shared
    source = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    capped = shared[source] >= most
    out = np.where(capped, 0, shared[source] - (np.arange(n) - source))
    return _extend(out, capped, source, word, before, most)


def _extend(out, capped, source, word, before, most):
    """Lengths of long matches, from the far end of each run to its beginning."""
    if not capped.any():
        return out
    rows = np.flatnonzero(capped)
    last = np.append(source[rows][1:] != source[rows][:-1], True)
    tips = rows[last]
    length = np.zeros(len(tips), np.int64)
    live, at = np.arange(len(tips)), 0
    while len(live) and at < most:
        differ = word[tips[live] + at] ^ word[before[tips[live]] + at]
        ended = differ != 0
        low = differ[ended] & (~differ[ended] + np.uint64(1))
        length[live[ended]] = at + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        live = live[~ended]
        at += 8
    length[live] = most
    group = np.cumsum(last) - last
    out[rows] = np.minimum(length[group] + tips[group] - rows, most)
    return out
