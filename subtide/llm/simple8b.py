"""Simple-8b: ids packed into 64-bit words. The upper four bits of a word select how many
ids of how many bits share the other 60. An id of over 60 bits takes two escape words."""

from __future__ import annotations

import struct

import numpy as np

#: Fixed values of the format: (ids in a word, bits of each), selectors 2 to 15.
SELECTORS = (
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7),
    (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
HIGH, LOW, FIRST = 0, 1, 2  # escape words with an id's upper and lower 32 bits; first packing selector
MAGIC, HEADER, BLOCK_WORDS = b"S8B1", struct.Struct("<4sIQQ"), 1024
IDS_IN = np.array([0, 1, *(n for n, _ in SELECTORS)], dtype=np.int64)
_SMALL_WIDTHS = np.array([max(1, int(i).bit_length()) for i in range(1 << 16)], dtype=np.uint8)


def _widths(ids: np.ndarray) -> np.ndarray:
    if not len(ids) or ids.max() < 1 << 16:
        return _SMALL_WIDTHS[ids]
    powers = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
    return np.maximum(np.searchsorted(powers, ids, side="right"), 1).astype(np.uint8)


def _choices(widths: np.ndarray) -> np.ndarray:
    """For each position the selector that packs the most ids from there on; zeros fill the
    last word. What no selector holds stays 0 and is escaped."""
    n = len(widths)
    widest = {1: np.concatenate([widths, np.ones(60, dtype=np.uint8)])}  # of so many ids from a position on
    choice = np.zeros(n, dtype=np.uint8)
    done = 1
    for selector in range(len(SELECTORS) - 1, -1, -1):  # the later choice packs more ids
        count, bits = SELECTORS[selector]
        if count not in widest:
            wide = widest[done]
            while done < count:
                more = max(c for c in widest if c <= count - done)
                wide = np.maximum(wide[: len(wide) - more], widest[more][done: done + len(wide) - more])
                done += more
            widest[count] = wide
        np.copyto(choice, selector + FIRST, where=widest[count][:n] <= bits)
    return choice


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words, and for each word the number of ids that start before it."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    n = len(ids)
    choice = _choices(_widths(ids))
    steps = np.where(choice < FIRST, 1, IDS_IN[choice]).astype(np.uint8).tobytes()
    chain, at = [], 0
    while at < n:
        chain.append(at)
        at += steps[at]
    starts = np.array(chain, dtype=np.int64)
    chosen = choice[starts]
    escaped = chosen < FIRST
    place = np.arange(len(starts)) + np.cumsum(escaped) - escaped  # an escape takes two words
    words = np.empty(len(starts) + int(escaped.sum()), dtype=np.uint64)
    before = np.empty(len(words), dtype=np.int64)
    before[place] = starts
    padded = np.concatenate([ids, np.zeros(60, dtype=np.uint64)])
    for selector, (count, bits) in enumerate(SELECTORS, FIRST):
        mine = np.flatnonzero(chosen == selector)
        if len(mine):
            word = np.full(len(mine), selector << 60, dtype=np.uint64)
            for k in range(count):
                word |= padded[starts[mine] + k] << np.uint64(k * bits)
            words[place[mine]] = word
    if escaped.any():
        value, where = ids[starts[escaped]], place[escaped]
        words[where] = (value >> np.uint64(32)) | np.uint64(HIGH << 60)
        words[where + 1] = (value & np.uint64(0xFFFFFFFF)) | np.uint64(LOW << 60)
        before[where + 1] = starts[escaped]
    return words, before


def unpack(words: np.ndarray) -> np.ndarray:
    """The ids of whole words; the last word may add zeros at the end."""
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = IDS_IN[selectors]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint64)
    first = ends - counts
    for selector, (count, bits) in enumerate(SELECTORS, FIRST):
        mine = np.flatnonzero(selectors == selector)
        if len(mine):
            word, at, mask = words[mine], first[mine], np.uint64((1 << bits) - 1)
            for k in range(count):
                out[at + k] = (word >> np.uint64(k * bits)) & mask
    low = np.flatnonzero(selectors == LOW)
    if len(low):
        out[first[low]] = (words[low - 1] << np.uint64(32)) | (words[low] & np.uint64(0xFFFFFFFF))
    return out


def to_bytes(ids: np.ndarray) -> bytes:
    """Header, the number of ids before each block of words, words; all little-endian."""
    words, before = pack(ids)
    # a block never starts between the two words of an escape: then it starts a word later
    cuts = np.arange(0, len(words), BLOCK_WORDS)
    cuts = cuts + ((words[cuts] >> np.uint64(60)) == LOW)
    table = np.stack([cuts, before[cuts]]) if len(words) else np.zeros((2, 0), dtype=np.int64)
    return HEADER.pack(MAGIC, table.shape[1], len(ids), len(words)) + table.astype("<i8").tobytes() + words.astype("<u8").tobytes()


def from_bytes(data: bytes, first: int = 0, count: int | None = None) -> np.ndarray:
    """The ids first, first + 1, ... (all, if no count is given); only the blocks that hold
    them are decoded."""
    magic, blocks, n, n_words = HEADER.unpack_from(data)
    if magic != MAGIC or len(data) != HEADER.size + 16 * blocks + 8 * n_words:
        raise ValueError("not a whole packed block of ids")
    cuts, before = np.frombuffer(data, "<i8", 2 * blocks, HEADER.size).reshape(2, blocks)
    words = np.frombuffer(data, "<u8", n_words, HEADER.size + 16 * blocks)
    last = n if count is None else min(n, first + count)
    if first >= last:
        return np.zeros(0, dtype=np.uint64)
    a = int(np.searchsorted(before, first, side="right")) - 1
    b = int(np.searchsorted(before, last, side="left"))
    end = int(cuts[b]) if b < blocks else n_words
    ids = unpack(words[int(cuts[a]): end])
    return ids[first - int(before[a]): last - int(before[a])]
