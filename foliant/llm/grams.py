"""Hashed byte trigrams of texts, shared by the text models."""

from __future__ import annotations

import numpy as np

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[0x41:0x5B] += 32
_FOLD[0x09:0x0E] = 0x20


def gram_counts(text: bytes | None, bits: int) -> np.ndarray:
    """Counts of the trigrams of ASCII-lower-cased text in 2 ** bits bins."""
    if not text:
        return np.zeros(1 << bits, np.int64)
    x = _FOLD[np.frombuffer(b" " + text + b" ", np.uint8)]
    code = (x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA6B) + x[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(32 - bits)
    return np.bincount(code, minlength=1 << bits)
