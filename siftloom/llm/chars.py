"""Text mapped character by character on flat arrays of code points, exactly as a function of whole texts would.

A table learns what the function makes of each character that occurs. Characters whose result depends on their
neighbours, or has several characters, are odd; a text with one of them goes through the function itself.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Sequence

import numpy as np

_SIZE = 0x110000
_GONE, _ODD, _UNSEEN = 0x110001, 0x110002, 0x110003


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts as one array, and each text's length."""
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype="<u4"), np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))


def _depends(ch: str) -> bool:
    """Whether a character may join with, or change with, those beside it."""
    parts = unicodedata.normalize("NFKD", ch)
    return any(unicodedata.category(c)[0] == "M" or unicodedata.combining(c) for c in ch + parts[:1]) or any(c in "Σσς" for c in parts) or "ᄀ" <= ch <= "ᇿ" or "ꥠ" <= ch <= "꥿" or "ힰ" <= ch <= "퟿"


class Table:
    """f of whole texts, for an f that works character by character but for what _depends tells and, with ``blanks``, for runs of blanks and blanks at the ends."""

    def __init__(self, f: Callable[[str], str], blanks: bool = False):
        self.f, self.blanks = f, blanks
        self.to = np.full(_SIZE, _UNSEEN, np.uint32)

    def _learn(self, cps: np.ndarray) -> None:
        for c in np.unique(cps[self.to[cps] == _UNSEEN]).tolist():
            ch = chr(c)
            if _depends(ch) or 0xD800 <= c < 0xE000:
                self.to[c] = _ODD
                continue
            out = self.f(f"x{ch}x")[1:-1] if self.blanks else self.f(ch)
            self.to[c] = _GONE if not out else ord(out) if len(out) == 1 else _ODD

    def map(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The results' code points one after the other, and each result's length."""
        cps, lens = code_points(texts)
        self._learn(cps)
        out = self.to[cps]
        ends = np.cumsum(lens)
        odd = np.flatnonzero(out == _ODD)
        if len(odd):
            done = list(texts)
            rows = np.unique(np.searchsorted(ends, odd, side="right"))
            for k in rows.tolist():
                done[k] = self.f(texts[k])
            # What f has made is taken as it stands.
            made, lens = code_points(done)
            ends = np.cumsum(lens)
            out = np.where(np.repeat(np.isin(np.arange(len(done)), rows), lens), made, self.to[made])
        keep = out != _GONE
        if self.blanks and len(out):
            out, keep = self._single_blanks(out, keep, ends, lens)
        kept = np.concatenate(([0], np.cumsum(keep)))
        return out[keep], kept[ends] - kept[ends - lens]

    @staticmethod
    def _single_blanks(out: np.ndarray, keep: np.ndarray, ends: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(keep)
        row = np.searchsorted(ends, at, side="right")
        blank = out[at] == 32
        before = np.ones(len(at), bool)
        before[1:] = (row[1:] != row[:-1]) | blank[:-1]
        last = np.ones(len(at), bool)
        last[:-1] = row[1:] != row[:-1]
        # A run keeps its first blank, unless the run is at either end of its text.
        drop = blank & before
        run_end = np.flatnonzero(blank & last)
        keep = keep.copy()
        keep[at[drop]] = False
        for k in run_end.tolist():  # the one blank that is left of a run at the end
            j = k
            while j >= 0 and blank[j] and row[j] == row[k]:
                keep[at[j]] = False
                j -= 1
        return out, keep

    def texts(self, texts: list[str]) -> list[str]:
        """f of each text."""
        out, lens = self.map(texts)
        joined = out.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        ends = np.cumsum(lens).tolist()
        return [joined[a:b] for a, b in zip([0, *ends], ends)]
