"""Suffix arrays by two-stage sorting, vectorised, and the prefixes that neighbours have in common.

A suffix is of the small type if it sorts before its successor: its first byte is less than the second, or
equal to it and the successor is small. Only small suffixes are sorted directly. The others are
induced: buckets by first byte are scanned in order, and a suffix whose predecessor in the text is of the large
type puts that predecessor at the end of what its own bucket has so far.
"""

from __future__ import annotations

import numpy as np


def small_type(text: np.ndarray) -> np.ndarray:
    """Per position: the suffix is smaller than its successor. The last position counts as small."""
    n = len(text)
    differ = np.append(text[:-1] != text[1:], True)
    nxt = np.minimum.accumulate(np.where(differ, np.arange(n), n)[::-1])[::-1]  # where the run of equal bytes ends
    less = np.append(text[:-1] < text[1:], True)
    return less[nxt]


def strings_at(data: bytes, depth: int) -> np.ndarray:
    """Per position the depth bytes from there, zeros beyond the end, as one item; nothing is copied but the text."""
    padded = np.frombuffer(data + bytes(depth), np.uint8)
    return np.ndarray(len(data), f"V{depth}", padded, strides=(1,))


def first_different(strings: np.ndarray, a: np.ndarray, b: np.ndarray, chunk: int = 1 << 14) -> np.ndarray:
    """The first word of 8 bytes in which the strings at a and b differ; the number of words if none."""
    words = strings.dtype.itemsize // 8
    out = np.full(len(a), words, np.int64)
    for k in range(0, len(a), chunk):
        x, y = (strings[p[k : k + chunk]].view(np.uint64).reshape(-1, words) for p in (a, b))
        differ = x != y
        out[k : k + chunk] = np.where(differ.any(axis=1), differ.argmax(axis=1), words)
    return out


def sort_direct(data: bytes, at: np.ndarray, depth: int) -> np.ndarray:
    """at, ascending, in the order of the strings of depth bytes that start there; equal ones in the order of at.

    By words of 8 bytes: groups that are equal so far go on with the first word in which their members differ.
    """
    if not len(at):
        return at
    words = -(-depth // 8)
    padded = data + bytes(8 * words + 8)
    word = np.ndarray(len(data) + 8 * words, ">u8", padded, strides=(1,))
    rest = np.uint64(~((1 << 8 * (8 * words - depth)) - 1) & ((1 << 64) - 1))  # of the last word the bytes within depth

    def key(p: np.ndarray, column: np.ndarray | int) -> np.ndarray:
        found = word[p + 8 * column].astype(np.uint64)
        return np.where(column == words - 1, found & rest, found)

    over = np.searchsorted(at, len(data) - depth, "right")  # these end with the text: before what only has zeros more
    out = np.concatenate([at[over:][::-1], at[:over]])
    out = out[np.lexsort([key(out, c) for c in reversed(range(min(3, words)))])]
    same = np.ones(len(out) - 1, bool)
    for c in range(min(3, words)):
        found = key(out, c)
        same &= found[1:] == found[:-1]
    strings = strings_at(data, 8 * words)
    # a group is a stretch of places in out whose strings are equal so far
    place = np.flatnonzero(np.append(same, False) | np.append(False, same))
    group = np.cumsum(~np.append(False, same))[place]
    while len(place):
        held = out[place]
        joined = group[1:] == group[:-1]
        column = np.full(len(held), words, np.int64)
        column[1:][joined] = first_different(strings, held[:-1][joined], held[1:][joined])
        first = np.flatnonzero(np.append(True, ~joined))
        column = np.repeat(np.minimum.reduceat(column, first), np.diff(np.append(first, len(held))))
        use = column < words
        place, group, held, column = place[use], group[use], held[use], column[use]
        found = key(held, column)
        order = np.lexsort([found, group])
        out[place] = held[order]
        found = found[order]
        same = (group[1:] == group[:-1]) & (found[1:] == found[:-1])
        use = (np.append(same, False) | np.append(False, same)) & (column < words - 1)
        group = np.cumsum(~np.append(False, same))[use] if len(use) else group
        place = place[use]
    return out


def suffix_order(data: bytes, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted positions (boolean by byte), in the order of the first depth bytes from there.

    Every wanted suffix of the large type needs its successor to be wanted too: close_up() sees to that.
    """
    text = np.frombuffer(data, np.uint8)
    small = small_type(text)
    direct = sort_direct(data, np.flatnonzero(wanted & small), depth)
    first = text[direct]
    cuts = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    large = wanted & ~small
    out: list[np.ndarray] = []

    def scan(found: np.ndarray) -> list[np.ndarray]:
        """Put the predecessors of found where they belong; those of the same bucket are returned."""
        before = found[found > 0] - 1
        before = before[large[before]]
        own = text[before]
        order = np.argsort(own, kind="stable")
        before, own = before[order], own[order]
        edges = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else []
        same = []
        for a, b in zip(edges, [*edges[1:], len(own)], strict=True) if len(own) else ():
            (same if own[a] == c else induced[own[a]]).append(before[a:b])
        return same

    for c in range(256):
        queue = induced[c]
        while queue:  # one round for each further repetition of c at the start
            found = np.concatenate(queue)
            out.append(found)
            queue = scan(found)
        found = direct[cuts[c] : cuts[c + 1]]
        if len(found):
            out.append(found)
            scan(found)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def close_up(text: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """wanted, and the successors up to the next small suffix of each wanted large one."""
    small = small_type(text)
    place = np.arange(len(text))
    stop = np.maximum.accumulate(np.where(small, place, -1))  # the last small suffix so far
    asked = np.maximum.accumulate(np.where(wanted & ~small, place, -1))
    before = np.append(-1, stop[:-1])
    return wanted | (asked > before)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix and the one before it in order, depth at most; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    strings = strings_at(text.tobytes(), -(-depth // 8) * 8)
    out[1:] = column = first_different(strings, order[:-1], order[1:])
    out *= 8
    at = np.flatnonzero(column < strings.dtype.itemsize // 8)
    word = np.ndarray(len(text) + strings.dtype.itemsize - 7, "V8", strings.base, strides=(1,))
    x, y = (word[order[at + k] + 8 * column[at]].view(np.uint8).reshape(-1, 8) for k in (0, 1))
    out[at + 1] += (x != y).argmax(axis=1)
    return np.minimum(out, depth)


def repeated(parts: list[bytes], windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of starts, below a part's number of windows, of length bytes that start elsewhere too: (part, first, end), in order."""
    data = b"\0".join(parts) + b"\0"
    text = np.frombuffer(data, np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(p) + 1 for p in parts])[:-1]]).astype(np.int64)
    is_window = np.zeros(len(text) + 1, np.int8)
    is_window[starts] = 1
    is_window[starts + windows] = -1  # before the next part, as a window has length bytes
    is_window = np.cumsum(is_window, dtype=np.int8)[:-1] > 0
    order = suffix_order(data, close_up(text, is_window), length)
    order = order[is_window[order]]
    long = common_prefixes(text, order, length) >= length
    hit = np.zeros(len(text) + 1, np.int8)
    hit[order[long]] = 1
    hit[order[np.flatnonzero(long) - 1]] = 1
    edge = np.diff(hit, prepend=np.int8(0))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # no stretch goes on into another part
    part = np.searchsorted(starts, first, "right") - 1
    return part, first - starts[part], end - starts[part]
