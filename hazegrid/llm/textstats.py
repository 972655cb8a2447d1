"""Words, windows and duplicates of one text as NumPy arrays; used inside tasks."""

from __future__ import annotations

import numpy as np

#: The white space that separates words: space, and 0x09 to 0x0D.
GAPS = b"\x20\x09\x0a\x0b\x0c\x0d"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def byte_set(members: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


def scramble(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64-bit numbers of integers (wraps around)."""
    x = x.astype(np.uint64) + _MULTIPLIER
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_numbers(raw: bytes) -> tuple[np.ndarray, int]:
    """The words of a text as numbers by first appearance, and how many differ. ``bytes.split`` splits at GAPS."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(w, len(seen)) for w in raw.split()], np.int64), len(seen)


def heads(b: np.ndarray) -> np.ndarray:
    """Code points before each byte, and in all (one entry more than bytes)."""
    out = np.zeros(len(b) + 1, np.int64)
    np.cumsum((b & 0xC0) != 0x80, out=out[1:])
    return out


def word_edges(b: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions where words start and end."""
    gap = np.ones(len(b) + 2, np.int8)
    gap[1:-1] = gaps[b]
    turn = np.diff(gap)
    return np.flatnonzero(turn == -1), np.flatnonzero(turn == 1)


def window_hashes(mixed: np.ndarray, n: int) -> np.ndarray:
    """Rolling hash of every window of n words (Horner's rule on all windows at once)."""
    m = len(mixed) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = mixed[:m].copy()
    for j in range(1, n):
        out *= _MULTIPLIER
        out += mixed[j:j + m]
    return out


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries occur twice or more, the first included."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def again(keys: np.ndarray) -> np.ndarray:
    """Which entries equal an earlier one."""
    out = np.zeros(len(keys), bool)
    if len(keys) > 1:
        order = np.argsort(keys, kind="stable")
        out[order[1:][keys[order[1:]] == keys[order[:-1]]]] = True
    return out


def covered(windows: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in a marked window of n words."""
    edge = np.zeros(words + 1, np.int64)
    at = np.flatnonzero(windows)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n, -1)
    return np.cumsum(edge[:-1]) > 0


def exact_windows(ids: np.ndarray, kinds: int, n: int, mixed: np.ndarray) -> np.ndarray:
    """One key per window of n words, equal only for equal windows (a number in base ``kinds`` if that fits in 63 bits)."""
    m = len(ids) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    if kinds ** n < 1 << 63:
        out = ids[:m].copy()
        for j in range(1, n):
            out = out * kinds + ids[j:j + m]
        return out
    return np.unique(np.stack([ids[j:j + m] for j in range(n)], 1), axis=0, return_inverse=True)[1].reshape(-1)
