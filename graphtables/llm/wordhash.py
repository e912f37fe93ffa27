"""Words of a text as 64-bit hashes, with numpy; rolling hashes over runs of them; sliding minima.

A hash of a run is the sum of random numbers of its elements times powers of an odd base, modulo
2**64, divided by the power it starts at: it depends on the run alone and not on its place.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
#: Bytes that are worked on at once; a longer text is cut at white space.
CHUNK = 1 << 20


def _solid(is_gap) -> np.ndarray:
    return np.array([not is_gap(b) for b in range(256)])


#: Words of [^\x20\x09-\x0D]+
SPACED = _solid(lambda b: b == 0x20 or 0x09 <= b <= 0x0D)
#: Words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing A-Z): digits, a-z, all that is not ASCII
LETTERS = _solid(lambda b: b <= 0x2F or 0x3A <= b <= 0x60 or 0x7B <= b <= 0x7F)
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit number over all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Rolling:
    """Hashes of runs for one base."""

    def __init__(self, seed: int):
        self.symbols = np.random.default_rng(seed).integers(0, 2**64, 256, dtype=_U)
        self.base = int(np.random.default_rng(seed + 1).integers(0, 2**62)) * 2 + 1
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, _U)

    def _powers(self, n: int):
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up = np.concatenate([[_U(1)], np.full(size - 1, self.base, _U)]).cumprod(dtype=_U)
            self.down = np.concatenate([[_U(1)], np.full(size - 1, self.inverse, _U)]).cumprod(dtype=_U)
        return self.up, self.down

    def sums(self, numbers: np.ndarray) -> np.ndarray:
        up, _ = self._powers(len(numbers) + 1)
        out = np.zeros(len(numbers) + 1, _U)
        np.cumsum(numbers * up[: len(numbers)], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, down = self._powers(len(sums))
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))

    def windows(self, numbers: np.ndarray, size: int) -> np.ndarray:
        """The hash of every ``size`` neighbours."""
        n = len(numbers) - size + 1
        if n <= 0:
            return np.zeros(0, _U)
        sums = self.sums(numbers)
        _, down = self._powers(n)
        return mix((sums[size:] - sums[:n]) * down[:n])


WORDS = Rolling(101)
FIRST, SECOND = Rolling(211), Rolling(307)


def word_spans(data: np.ndarray, solid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end among the bytes."""
    flags = np.zeros(len(data) + 2, np.int8)
    flags[1:-1] = solid[data]
    turn = np.diff(flags)
    return np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)


def to_bytes(text: str | None, lower: bool = False) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    return LOWER[data] if lower else data


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    out = np.zeros(len(starts), _U)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, side="right")))
        at = starts[i]
        sums = WORDS.sums(WORDS.symbols[data[at : ends[j - 1]]])
        out[i:j] = WORDS.runs(sums, starts[i:j] - at, ends[i:j] - at)
        i = j
    return out


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` neighbours."""
    if len(values) < size:
        return values[:0]
    out, have = values, 1
    while have * 2 <= size:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = size - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out
