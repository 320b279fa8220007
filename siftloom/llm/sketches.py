"""Bottom-k sketches of the two-character pieces of a text, all from one hash function.

Each piece is hashed once. A view multiplies these hashes by an odd number, which permutes them, and retains the smallest.
Everything here works on whole Arrow batches as flat arrays: the texts' code points one after the other.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import numpy as np

from .chars import Table, code_points
from .looks import unify_one

SIM = 0.7
_M64 = (1 << 64) - 1


class _Letters(dict):
    """Translation that keeps letters and decimal digits."""

    def __missing__(self, cp: int) -> int | None:
        kind = unicodedata.category(chr(cp))
        self[cp] = cp if kind[0] == "L" or kind == "Nd" else None
        return self[cp]


_LETTERS = _Letters()
_SPACE = re.compile(r"\s+")


def letters_form(title: str) -> str:
    """Letters and decimal digits of the title's consistent form, in lower case."""
    return unify_one(title, fold=False).lower().translate(_LETTERS)


def pieces(form: str) -> frozenset[str]:
    return frozenset(map("".join, zip(form, form[1:])))


def similarity(a: str, b: str) -> float:
    """Shared pieces over all pieces of two forms; equal forms are 1 even if too short for a piece."""
    if a == b:
        return 1.0
    x, y = pieces(a), pieces(b)
    both = len(x & y)
    return both / (len(x) + len(y) - both) if both else 0.0


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_FORMS = Table(letters_form)


def letters_forms(titles: list[str]) -> list[str]:
    """letters_form of each title."""
    return _FORMS.texts(titles)


class Batch:
    """Hashes of the distinct pieces of a batch of forms; forms with no piece are left out and listed in ``bare``."""

    def __init__(self, forms: Sequence[str]):
        cps, lens = code_points(forms)
        start = np.concatenate(([0], np.cumsum(lens)[:-1])).astype(np.int64)
        row = np.repeat(np.arange(len(forms)), lens)
        if len(cps) > 1:
            inside = row[1:] == row[:-1]
            raw = (cps[:-1].astype(np.uint64) << np.uint64(21) | cps[1:].astype(np.uint64))[inside]
            row = row[:-1][inside]
        else:
            raw, row = np.empty(0, np.uint64), np.empty(0, np.int64)
        h = mix(raw + np.uint64(0x9E3779B97F4A7C15))
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        self.h, row = h[fresh], row[fresh]
        self.rows, self.starts, self.sizes = np.unique(row, return_index=True, return_counts=True)
        self.bare = np.setdiff1d(np.arange(len(start)), self.rows)

    def view(self, by: np.uint64, r: int) -> np.ndarray:
        """(texts, r): the r smallest hashes in the view, ascending; the highest number where a text has fewer pieces."""
        h, top = self.h * by, np.uint64(_M64)
        out = np.empty((len(self.rows), r), np.uint64)
        for k in range(r):
            out[:, k] = np.minimum.reduceat(h, self.starts) if len(h) else 0
            if k + 1 < r:
                h[h == np.repeat(out[:, k], self.sizes)] = top
        return out

    def within(self) -> np.ndarray:
        """The place of each hash among its text's, which stand in ascending order."""
        return np.arange(len(self.h)) - np.repeat(self.starts, self.sizes)

    def parity(self) -> np.ndarray:
        """64 bits a text: bit k tells whether an odd number of its pieces fall on k. Two texts differ in no more bits than pieces."""
        return np.bitwise_xor.reduceat(np.uint64(1) << (self.h >> np.uint64(58)), self.starts) if len(self.h) else np.empty(0, np.uint64)


def may_be_similar(bits: np.ndarray, other_bits: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    """False only for texts that can't reach SIM: by their numbers of pieces, or as more bits of their parities differ than pieces may."""
    small, large = np.minimum(size, other), np.maximum(size, other)
    return (small >= SIM * large - 1e-9) & (np.bitwise_count(bits ^ other_bits) <= (1 - SIM) / (1 + SIM) * (small + large) + 1e-9)


def jaccard(a: Sequence[str], b: Sequence[str], least: int | None = None) -> np.ndarray:
    """Shared pieces over all pieces, pair by pair, or with ``least`` over the so many smallest hashes of the two sketches' union.

    The hash of a piece is one-to-one, so without ``least`` the result is exact. Equal forms are 1.
    """
    n = len(a)
    x, y = Batch(a), Batch(b)
    pair = np.concatenate((np.repeat(x.rows, x.sizes), np.repeat(y.rows, y.sizes)))
    h = np.concatenate((x.h, y.h))
    if least is not None:
        keep = np.concatenate((x.within(), y.within())) < least
        pair, h = pair[keep], h[keep]
    order = np.lexsort((h, pair))
    pair, h = pair[order], h[order]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (pair[1:] == pair[:-1])
    first = np.flatnonzero(~again)
    both = np.zeros(len(first), bool)
    both[np.cumsum(~again)[again] - 1] = True
    pair = pair[first]
    if least is not None:
        _, start, size = np.unique(pair, return_index=True, return_counts=True)
        keep = np.arange(len(pair)) - np.repeat(start, size) < least
        pair, both = pair[keep], both[keep]
    shared, union = np.bincount(pair[both], minlength=n), np.bincount(pair, minlength=n)
    same = np.fromiter((p == q for p, q in zip(a, b)), bool, n)
    return np.where(same, 1.0, shared / np.maximum(union, 1))
