"""Positions of a text that its own bytes choose, and digests of the byte strings around them.

Every string of `LENGTH` bytes holds some strings of `SEED` bytes; the leftmost of those with
the smallest hash is its anchor. Equal strings have their anchor at the same place, wherever
they stand. One anchor serves a run of neighbouring strings: its starts.
"""

from __future__ import annotations

import numpy as np

LENGTH = 100
SEED = 32
WIDTH = LENGTH - SEED + 1
#: Bytes that are hashed at once; longer texts are cut, with an overlap.
PIECE = 1 << 17


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _odd(seed: int, n: int) -> np.ndarray:
    state = np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return _mixed(_mixed(state)) | np.uint64(1)


STEPS = _odd(1, SEED // 8)
BYTES = _odd(2, 256)
BASE = 0x9E3779B97F4A7C15
POWERS = np.cumprod(np.r_[np.uint64(1), np.full(PIECE + LENGTH, BASE, np.uint64)])
BACK = np.cumprod(np.r_[np.uint64(1), np.full(PIECE + LENGTH, pow(BASE, -1, 2**64), np.uint64)])


class Strings:
    """Hashes over some bytes of at most PIECE + LENGTH."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTES[data] * POWERS[: len(data)], out=self.sums[1:])

    def digest(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Digests of the strings from begin to end (excluded)."""
        return _mixed((self.sums[end] - self.sums[begin]) * BACK[begin])

    def anchors(self, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchors of the strings that start where `valid` is true: the hash and place of
        each, the first start it serves and how many."""
        n = len(self.data)
        eight = np.zeros(n - 7, np.uint64)
        for i in range(8):
            part = self.data[i : i + (n - i) // 8 * 8].view("<u8")
            eight[i::8] = part
        seeds = n - SEED + 1
        h = np.zeros(seeds, np.uint64)
        for k, step in enumerate(STEPS):
            part = eight[8 * k : 8 * k + seeds] * step
            h += part ^ (part >> np.uint64(29))
        h = _mixed(h)
        # The smallest hash over WIDTH places, by doubling
        least, width = h, 1
        while 2 * width <= WIDTH:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < WIDTH:
            least = np.minimum(least[: -(WIDTH - width)], least[WIDTH - width :])
        least = least[: len(valid)]
        new = np.r_[True, least[1:] != least[:-1]] | np.r_[True, ~valid[:-1]]
        first = np.flatnonzero(new & valid)
        stop = np.flatnonzero(valid & np.r_[new[1:] | ~valid[1:], True]) + 1
        if not len(first):
            none = np.zeros(0, np.int64)
            return none.astype(np.uint64), none, none, none
        done = []
        view = np.lib.stride_tricks.sliding_window_view(h, WIDTH)
        while len(first):
            at = np.concatenate(
                [
                    p + (view[p] == least[p, None]).argmax(1)
                    for p in np.array_split(first, len(first) // 16384 + 1)
                ]
            )
            # Where the same hash comes again, an anchor serves no start behind itself
            last = np.minimum(stop, at + 1)
            done.append((h[at], at, first, last - first))
            more = last < stop
            first, stop = last[more], stop[more]
        found = tuple(np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(found[2], kind="stable")
        return tuple(x[order] for x in found)


def pieces(texts: list[bytes]):
    """Bytes of several texts in one array at most PIECE long where possible: yields the
    array, which starts are valid, the number of each text and where it begins.

    A text over PIECE comes in parts that overlap by LENGTH - 1 bytes: each of its strings
    is valid in one of them. Texts shorter than LENGTH hold no string and are left out.
    """
    parts: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - LENGTH + 1, PIECE):
            part = text[at : at + PIECE + LENGTH - 1]
            if size and size + len(part) > PIECE:
                yield _joined(parts)
                parts, size = [], 0
            parts.append((i, at, part))
            size += len(part)
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple[int, int, bytes]]):
    sizes = np.array([len(p) for _, _, p in parts])
    data = np.frombuffer(b"".join([p for _, _, p in parts]), np.uint8)
    starts = np.cumsum(sizes) - sizes
    valid = np.ones(len(data) - LENGTH + 1, bool)
    for end in np.cumsum(sizes)[:-1].tolist():
        valid[end - LENGTH + 1 : end] = False
    return (
        data,
        valid,
        np.array([i for i, _, _ in parts]),
        starts,
        np.array([at for _, at, _ in parts]),
    )
