"""Simple-8b with an escape: ids packed into 64-bit words, in blocks that decode on their own.

The top four bits of a word select how many ids of how many bits follow. Blocks hold a fixed number of ids and start at
known words, so encoding advances through all blocks of an array at once and decoding is one gather per selector.
"""

from __future__ import annotations

import numpy as np

#: Selector 0: escape, the next word holds one id of more than 60 bits. Selector 1: 120 zeros. Then (ids, bits each).
COUNT = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
MOST = int(COUNT.max())


def _selectors(width: np.ndarray, reach: int) -> np.ndarray:
    """For each place, the selector that takes the most ids from there on. width: bits of ids, blocks by places."""
    best = np.zeros((width.shape[0], reach), dtype=np.int8)
    largest, span, power = width, 1, {1: width}
    while span * 2 <= MOST:
        largest = np.maximum(largest[:, : largest.shape[1] - span], largest[:, span:])
        span *= 2
        power[span] = largest
    for selector in range(15, 0, -1):
        count = int(COUNT[selector])
        p = 1 << (count.bit_length() - 1)
        top = np.maximum(power[p][:, :reach], power[p][:, count - p : count - p + reach])
        best[top <= BITS[selector]] = selector
    return best


#: Blocks that are encoded or decoded at once, so that what this takes beside the ids is bounded.
AT_ONCE = 512


def encode(ids: np.ndarray, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the first word of each block (one more for the end)."""
    step = AT_ONCE * block
    if len(ids) <= step:
        return _encode(ids, block)
    words, first, upto = [], [np.zeros(1, dtype=np.int64)], 0
    for start in range(0, len(ids), step):
        its, at = _encode(ids[start : start + step], block)
        words.append(its)
        first.append(at[1:] + upto)
        upto += len(its)
    return np.concatenate(words), np.concatenate(first)


def _encode(ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(ids)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    blocks = -(-n // block)
    values = np.zeros((blocks, block + MOST), dtype=np.uint64)
    flat = np.zeros(blocks * block, dtype=np.uint64)
    flat[:n] = ids
    values[:, :block] = flat.reshape(blocks, block)
    width = np.frexp(values.astype(np.float64))[1].astype(np.int8)
    best = _selectors(width, block)
    end = np.full(blocks, block, dtype=np.int64)
    end[-1] = n - (blocks - 1) * block
    lane, place = np.arange(blocks), np.zeros(blocks, dtype=np.int64)
    lanes, places, chosen = [], [], []
    while len(lane):
        s = best[lane, place]
        lanes.append(lane)
        places.append(place)
        chosen.append(s)
        place = place + COUNT[s]
        on = place < end[lane]
        lane, place = lane[on], place[on]
    lane, place, selector = np.concatenate(lanes), np.concatenate(places), np.concatenate(chosen)
    order = np.lexsort((place, lane))
    lane, place, selector = lane[order], place[order], selector[order].astype(np.int64)
    size = np.where(selector == 0, 2, 1)
    at = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), dtype=np.uint64)
    start = lane * (block + MOST) + place
    source = values.reshape(-1)
    for s in range(1, 16):
        mine = np.flatnonzero(selector == s)
        if len(mine):
            packed = np.full(len(mine), s << 60, dtype=np.uint64)
            for k in range(int(COUNT[s]) if s > 1 else 0):
                packed |= source[start[mine] + k] << np.uint64(k * int(BITS[s]))
            words[at[mine]] = packed
    escaped = np.flatnonzero(selector == 0)
    words[at[escaped] + 1] = source[start[escaped]]
    per_block = np.bincount(lane, weights=size, minlength=blocks).astype(np.int64)
    return words, np.concatenate(([0], np.cumsum(per_block)))


def decode(words: np.ndarray, first: np.ndarray, n: int, block: int = 1024) -> np.ndarray:
    """All n ids. A few blocks alone: give their words, their first words less the first of these, and their ids' number."""
    if not n:
        return np.zeros(0, dtype=np.uint64)
    if n <= AT_ONCE * block:
        return _decode(words, first, n, block)
    out = np.empty(n, dtype=np.uint64)
    for b in range(0, len(first) - 1, AT_ONCE):
        at = first[b : b + AT_ONCE + 1]
        some = slice(b * block, min(n, (b + AT_ONCE) * block))
        out[some] = _decode(words[at[0] : at[-1]], at - at[0], some.stop - some.start, block)
    return out


def _decode(words: np.ndarray, first: np.ndarray, n: int, block: int) -> np.ndarray:
    selector = (words >> np.uint64(60)).astype(np.int64)
    literal = np.zeros(len(words), dtype=bool)
    for i in np.flatnonzero(selector == 0).tolist():
        if not literal[i]:
            literal[i + 1] = True
    at = np.flatnonzero(~literal)
    selector = selector[at]
    count = COUNT[selector]
    before = np.cumsum(count) - count
    owner = np.searchsorted(first, at, side="right") - 1
    heads = np.searchsorted(at, first[:-1])
    place = before - before[heads][owner]
    room = np.minimum(block, n - owner * block) - place  # ids that the block still has from here on
    target = owner * block + place
    out = np.zeros(n, dtype=np.uint64)
    for s in range(16):
        mine = np.flatnonzero(selector == s)
        if not len(mine) or s == 1:
            continue
        word = words[at[mine] + (s == 0)]
        for k in range(int(COUNT[s])):
            here = mine if not k else np.flatnonzero(room[mine] > k)
            if not k:
                out[target[mine]] = word if s == 0 else word & np.uint64((1 << int(BITS[s])) - 1)
            else:
                out[target[mine[here]] + k] = (word[here] >> np.uint64(k * int(BITS[s]))) & np.uint64((1 << int(BITS[s])) - 1)
    return out
