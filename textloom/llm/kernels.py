"""Vectorised text kernels that work on a whole Arrow batch of strings at once.

Texts are laid end to end with U+0000 between them, so that one C-level call (lower, normalize,
encode) serves thousands of texts and NumPy does the rest on the array of code points.
"""

from __future__ import annotations

import numpy as np

M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def space_table() -> np.ndarray:
    """Flags of the code points that Python calls white space (all lie below U+3001)."""
    flags = np.zeros(0x110000, bool)
    for i in range(0x3001):
        flags[i] = chr(i).isspace()
    return flags


_SPACE: np.ndarray | None = None


def spaces() -> np.ndarray:
    global _SPACE
    if _SPACE is None:
        _SPACE = space_table()
    return _SPACE


def join_texts(texts: list[str | None]) -> str:
    """All texts in one string, U+0000 between them (one inside a text becomes a blank); null is empty."""
    parts = [t or "" for t in texts]
    big = "\0".join(parts)
    if big.count("\0") != len(parts) - 1:
        big = "\0".join([p.replace("\0", " ") for p in parts])
    return big


def codes_of(big: str) -> np.ndarray:
    return np.frombuffer(big.encode("utf-32-le", "surrogatepass"), np.uint32)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """A full-avalanche permutation of 64-bit words."""
    h = h + np.uint64((seed * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * M2
    h = (h ^ (h >> np.uint64(27))) * M3
    return h ^ (h >> np.uint64(31))


def gram_hashes(codes: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every q-gram that crosses no U+0000, and the index of the text it is from."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    wide = codes.astype(np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(q):
        h += wide[k : n + k]
        h *= M1
    ends = np.cumsum(codes == 0, dtype=np.int64)
    before = np.concatenate(([0], ends))
    whole = before[q:] == before[:n]
    return mix(h[whole]), before[:n][whole]
