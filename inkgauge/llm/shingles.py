"""Word shingles of a text as 64-bit hashes, computed with numpy on its bytes.

Words are runs of bytes other than space, tab and line ends (\\x09-\\x0D); A-Z
count as a-z. A word's hash is a polynomial in random values of its bytes, taken
from prefix sums, so a text costs a few passes over arrays and no loop.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20  # bytes hashed at once; a longer text is cut between words
_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUES[65:91] = _VALUES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["up"]) < n:
        n = max(n, BLOCK + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def _hash_block(raw: np.ndarray) -> np.ndarray:
    inside = np.empty(len(raw) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[raw], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _power_table(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * up[: len(raw)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: str | None) -> np.ndarray:
    """One hash per word, in order."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if len(raw) <= BLOCK:
        return _hash_block(raw) if len(raw) else np.empty(0, np.uint64)
    parts, at = [], 0
    while at < len(raw):
        end = at + BLOCK
        while end < len(raw):
            gaps = np.flatnonzero(_SPACE[raw[end : end + 4096]])
            if len(gaps):
                end += gaps[0]
                break
            end += 4096
        parts.append(_hash_block(raw[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of all words where there are fewer."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    found = np.full(n, width, np.uint64)
    for i in range(width):
        found = mix(found * _STEP + words[i : i + n])
    return np.unique(found)
