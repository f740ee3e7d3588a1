"""Simple-8b: 60 data bits and a 4-bit selector a word, vectorised over blocks with numpy.

Ids are cut into blocks of BLOCK. Each word's selector tells how many ids of which width it holds; an id of 60 bits
or more takes an escape word and one raw word. A block's words start at its offset, so that blocks decode apart.
The last word of a block is padded with zeros; a block's number of ids is known from its place.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
#: Ids a word and bits an id, by selector (fixed values of the format).
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15
#: The widest selector that holds an id, for ids under 2^17; others are searched.
_NARROW = np.searchsorted(WIDTHS, np.ceil(np.log2(np.arange(1 << 17) + 1)).clip(1)).astype(np.uint8)


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint64) and each block's first word (uint32)."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    places = np.arange(n, dtype=np.int32)
    ends = np.minimum((places // BLOCK + 1) * BLOCK, n)
    left = ends - places
    if ids.max() < len(_NARROW):
        need = _NARROW[ids.astype(np.int64)]
    else:
        need = np.searchsorted(np.uint64(1) << WIDTHS.astype(np.uint64), ids, side="right").astype(np.uint8)
    most = min(int(need.max()), len(COUNTS) - 1)  # whatever comes next fits a word of this selector
    selector = np.full(n, most, np.uint8)
    for s in range(most - 1, -1, -1):
        count = COUNTS[s]
        wide = np.flatnonzero(need > s).astype(np.int32)
        if len(wide) and np.diff(wide, prepend=-1, append=n).max() <= count:
            if s < 4:
                break  # narrower ones have shorter runs and need longer ones
            continue
        stop = np.repeat(np.append(wide, np.int32(n)), np.diff(wide, prepend=-1, append=n - 1))
        np.copyto(selector, s, where=np.minimum(stop - places, left) >= np.minimum(count, left))
    selector[need >= len(COUNTS)] = ESCAPE
    step = np.append(COUNTS, [1, 1])[selector]
    current = np.arange(0, n, BLOCK)
    stops = np.minimum(current + BLOCK, n)
    taken = []
    while len(current):
        taken.append(current)
        current = current + step[current]
        alive = current < stops
        current, stops = current[alive], stops[alive]
    at = np.sort(np.concatenate(taken))
    chosen = selector[at]
    words = chosen.astype(np.uint64) << np.uint64(60)
    padded = np.append(ids, np.zeros(64, np.uint64))
    for s in np.unique(chosen):
        if s == ESCAPE:
            continue
        which = np.flatnonzero(chosen == s)
        start = at[which]
        word = padded[start]
        for k in range(1, COUNTS[s]):
            word |= padded[start + k] << np.uint64(k * WIDTHS[s])
        last = np.flatnonzero(left[start] < COUNTS[s])  # no ids of the next block in a block's last word
        word[last] &= (np.uint64(1) << (left[start[last]] * WIDTHS[s]).astype(np.uint64)) - np.uint64(1)
        words[which] |= word
    escaped = chosen == ESCAPE
    sizes = np.bincount(at // BLOCK, weights=1 + escaped).astype(np.int64)
    if escaped.any():
        words = np.insert(words, np.flatnonzero(escaped) + 1, ids[at[escaped]])
    return words, (np.cumsum(sizes) - sizes).astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The n ids (uint64)."""
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    full = selector == ESCAPE
    place = np.arange(len(words))
    run = place - np.maximum.accumulate(np.where(full, -1, place))
    escape = full & (run % 2 == 1)
    raw = np.append(False, escape[:-1])
    count = np.append(COUNTS, [1, 1])[selector] * ~raw
    block = np.searchsorted(offsets, place, side="right") - 1
    before = np.cumsum(count) - count
    start = block * BLOCK + before - before[offsets[block]]
    stop = np.minimum((block + 1) * BLOCK, n)
    out = np.zeros(n, np.uint64)
    for s in np.unique(selector[~raw & ~escape]):
        which = np.flatnonzero((selector == s) & ~raw & ~escape)
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(COUNTS[s]):
            inside = which[start[which] + k < stop[which]]
            out[start[inside] + k] = (words[inside] >> np.uint64(k * WIDTHS[s])) & mask
    out[start[escape]] = words[1:][escape[:-1]] if escape.any() else 0
    return out
