"""Content-defined anchors: where two texts share a long string, they choose the same places of it.

In every window of LENGTH bytes the anchor is the k-gram of the smallest hash, the leftmost of equals. Windows in a
row that have one anchor are a run. Equal windows have equal anchors, so it is enough to compare runs whose
anchors' hashes are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LENGTH = 200
GRAM = 48
PIECE = 1 << 17  #: bytes hashed at a time, so that arrays stay in the cache; places in a piece have 17 bits
PLACE = np.uint64(PIECE - 1)

MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
BASE = 0x9E3779B97F4A7C15


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Roller:
    """Polynomial hashes of any substring of a piece from one prefix sum."""

    def __init__(self) -> None:
        self.table = np.random.default_rng(200).integers(0, 1 << 64, 256, dtype=np.uint64)
        self.up = powers(BASE, PIECE + 1)
        self.down = powers(pow(BASE, -1, 1 << 64), PIECE + 1)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.up[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[start]) * self.down[start])

    def grams(self, sums: np.ndarray, k: int) -> np.ndarray:
        n = len(sums) - k
        return mix((sums[k:] - sums[:-k]) * self.down[:n])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * MIX1
    x = (x ^ (x >> np.uint64(33))) * MIX2
    return x ^ (x >> np.uint64(33))


def window_least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w values in a row, from running minima of blocks in both directions."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, ~np.uint64(0))
    padded[: len(x)] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def pieces(texts: list[bytes]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Texts joined into pieces: ([(index of the text, offset in the text, start in the piece)], bytes).

    A text longer than a piece is cut with an overlap of LENGTH - 1, so each window is in one part.
    """
    held: list[tuple[int, int, int]] = []
    data: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        if len(text) < LENGTH:
            continue
        for at in range(0, len(text) - LENGTH + 1, PIECE - LENGTH + 1):
            part = text[at : at + PIECE]
            if size + len(part) > PIECE:
                yield held, b"".join(data)
                held, data, size = [], [], 0
            held.append((i, at, size))
            data.append(part)
            size += len(part)
    if held:
        yield held, b"".join(data)


def runs(texts: list[bytes], roller: Roller) -> dict[str, np.ndarray]:
    """Arrays: text (index), start (of the first window), count (of windows), key (of the anchor), place
    (the anchor's offset from the start), print (hash of all bytes that the windows cover)."""
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("text", "start", "count", "key", "place", "print")}
    for held, data in pieces(texts):
        raw = np.frombuffer(data, np.uint8)
        sums = roller.sums(raw)
        grams = roller.grams(sums, GRAM)
        least = window_least((grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64), LENGTH - GRAM + 1)
        place = (least & PLACE).astype(np.int64)
        starts = np.array([h[2] for h in held])
        owner = np.repeat(np.arange(len(held)), np.diff(np.append(starts, len(raw))))
        whole = owner[: len(place)] == owner[LENGTH - 1 :]  # the window lies in one text
        change = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (whole[1:] != whole[:-1])]))
        count = np.diff(np.append(change, len(place)))
        use = whole[change]
        s, n = change[use], count[use]
        own = owner[s]
        out["text"].append(np.array([h[0] for h in held])[own])
        out["start"].append(s - starts[own] + np.array([h[1] for h in held])[own])
        out["count"].append(n)
        out["key"].append(grams[place[s]])
        out["place"].append(place[s] - s)
        out["print"].append(roller.of(sums, s, s + n + LENGTH - 1))
    return {k: np.concatenate(v) if v else np.zeros(0, np.uint64 if k in ("key", "print") else np.int64) for k, v in out.items()}
