"""Code points of texts as arrays, with letter and lower-case tables over all of Unicode."""

from __future__ import annotations

from functools import lru_cache

import numpy as np


@lru_cache(1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter, and its lower-case form where that is one code point."""
    letter = np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            letter[i] = True
            low = c.lower()
            if len(low) == 1:
                lower[i] = ord(low)
    return letter, lower


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
