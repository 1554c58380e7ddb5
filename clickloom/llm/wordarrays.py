"""Words of a batch of texts as one Arrow array, cut without a loop over words.

Words compare by their bytes (Arrow's own hash tables), so ids taken from them
are exact, not hashes.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class WordArray:
    """The maximal runs of bytes outside ``separators`` of every text (null: none),
    A-Z lower-cased. ``words`` is an Arrow string array, ``doc`` the index of each
    word's text, ``breaks`` the number of bytes of ``breaking`` (a part of the
    separators) before each word; texts are a break apart."""

    def __init__(self, texts: Iterable[str | None], separators: bytes, breaking: bytes = b""):
        raw = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER) for t in texts]
        apart = bytes([(breaking or separators)[0]])
        buf = np.frombuffer(apart.join(raw) + apart, np.uint8)
        ends = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64) if raw else np.zeros(0, np.int64)
        is_word = np.ones(256, bool)
        is_word[list(separators)] = False
        inside = is_word[buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        lo, hi = edge[0::2], edge[1::2]
        offsets = np.zeros(len(lo) + 1, np.int64)
        np.cumsum(hi - lo, out=offsets[1:])
        self.words = pa.Array.from_buffers(pa.large_string(), len(lo), [None, pa.py_buffer(offsets), pa.py_buffer(buf[inside])])
        self.doc = np.searchsorted(ends, lo, side="right")
        self.texts = len(raw)
        if breaking:
            breaks = np.zeros(256, bool)
            breaks[list(breaking)] = True
            self.breaks = np.cumsum(breaks[buf])[lo] if len(lo) else np.zeros(0, np.int64)

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.bincount(self.doc, minlength=self.texts)
