"""An R-tree over count vectors, searched by the overlap two sets can have at most.

Shingles are hashed into groups; a set's counts per group are a point. Two sets share at most the sum of
the smaller counts, and no more than the sum of the smaller of a set's counts and the upper corner of a
box with any set in that box.
"""

from __future__ import annotations

import numpy as np

GROUPS = 256
LEAF = 32
FANOUT = 8


def groups_for(n: int) -> int:
    """Groups for a set of n shingles, about four of them in each; a power of two."""
    return max(GROUPS, 1 << ((n - 1) // 4).bit_length())


def count_vector(shingles: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """Shingles per group, told by bits that the order of the hashes does not use."""
    own = (shingles & np.uint64(groups - 1)).astype(np.int64)
    return np.bincount(own, minlength=groups).astype(np.int32)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """The counts in fewer groups."""
    return counts.reshape(-1, groups).sum(axis=0)


def packed(counts: np.ndarray) -> bytes:
    """A count vector in bytes: the width of a count and the counts."""
    width = 1 if counts.max(initial=0) < 1 << 8 else 2 if counts.max() < 1 << 16 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int32)


def overlap_bound(a: np.ndarray, b: np.ndarray) -> int:
    """How many shingles two sets can share, by their counts in the groups both have."""
    groups = min(len(a), len(b))
    return int(np.minimum(folded(a, groups), folded(b, groups)).sum())


def may_link(overlap: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether an overlap is enough: 100 i >= 75 (a + b - i)."""
    return 7 * overlap >= 3 * (size_a + size_b)


class RTree:
    """Packed by cutting along the group whose counts vary most, down to small leaves."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.sizes = points.sum(axis=1)
        self.upper: list[np.ndarray] = []
        self.least: list[int] = []
        self.children: list[list[int] | np.ndarray] = []
        self.root = self._pack(np.arange(len(points)))

    def _pack(self, rows: np.ndarray) -> int:
        own = self.points[rows]
        number = len(self.upper)
        self.upper.append(own.max(axis=0))
        self.least.append(int(self.sizes[rows].min()))
        self.children.append(rows)
        spread = own.max(axis=0) - own.min(axis=0)
        if len(rows) > LEAF and spread.max() > 0:
            ordered = rows[np.argsort(own[:, spread.argmax()], kind="stable")]
            parts = np.array_split(ordered, min(FANOUT, -(-len(rows) // LEAF)))
            self.children[number] = [self._pack(part) for part in parts]
        return number

    def search(self, point: np.ndarray) -> np.ndarray:
        """Rows whose overlap bound with the point is enough for a link."""
        size, found, open_ = int(point.sum()), [], [self.root]
        while open_:
            number = open_.pop()
            bound = np.minimum(point, self.upper[number]).sum()
            if not may_link(bound, size, self.least[number]):
                continue
            below = self.children[number]
            if isinstance(below, list):
                open_.extend(below)
            else:
                bounds = np.minimum(point, self.points[below]).sum(axis=1)
                found.append(below[may_link(bounds, size, self.sizes[below])])
        return np.concatenate(found) if found else np.empty(0, np.int64)
