"""Words and hashes of texts, vectorised over a buffer of many texts.

Words are runs of bytes other than ASCII white space (the same cuts as the
pattern ``[^\\x20\\x09-\\x0D]+`` on code points; ``bytes.split()`` makes them
too). Hashes are 64-bit polynomials over the bytes, finished by a mixer."""

from __future__ import annotations

import numpy as np

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
SEGMENT = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Values of the bytes, by seed: two independent hashes of the same span.
_BYTES = np.random.Generator(np.random.PCG64(7)).integers(1, 2**64, (2, 256), dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            inverse = np.uint64(pow(int(_BASE), -1, 2**64))
            with np.errstate(over="ignore"):
                steps = [np.full(n + 1, b, dtype=np.uint64) for b in (_BASE, inverse)]
                for s in steps:
                    s[0] = 1
                    np.multiply.accumulate(s, out=s)
            self.up, self.down = steps
        return self.up, self.down


_POWERS = _Powers()


def prefix_hashes(data: np.ndarray, seed: int = 0) -> np.ndarray:
    """c with c[j] - c[i] = polynomial of data[i:j], times the base to the i."""
    up, _ = _POWERS.of(len(data))
    c = np.zeros(len(data) + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_BYTES[seed][data] * up[: len(data)], out=c[1:])
    return c


def span_hashes(c: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Unmixed hash of data[start:stop] for each pair, equal for equal bytes."""
    _, down = _POWERS.of(len(c) - 1)
    with np.errstate(over="ignore"):
        return (c[stop] - c[start]) * down[start]


def hashed_spans(data: np.ndarray, start: np.ndarray, stop: np.ndarray, seed: int = 0) -> np.ndarray:
    """Mixed hash of each data[start:stop], ``start`` ascending, in segments:
    memory does not grow with the buffer."""
    out = np.empty(len(start), dtype=np.uint64)
    i = 0
    while i < len(start):
        lo = int(start[i])
        j = int(np.searchsorted(start, lo + SEGMENT, side="left"))
        c = prefix_hashes(data[lo : int(stop[i:j].max())], seed)
        length = (stop[i:j] - start[i:j]).astype(np.uint64)
        with np.errstate(over="ignore"):
            out[i:j] = mixed(span_hashes(c, start[i:j] - lo, stop[i:j] - lo) + length * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts, each followed by a line feed, and their starts."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return data, np.concatenate([[0], np.cumsum(lengths)])


def word_hashes(texts: list[bytes], *, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word of all texts in order, index of its text). The
    buffer is hashed in segments cut at white space, so that a very long text
    needs no more memory than its words."""
    data, starts = joined(texts)
    hashes, at = [], []
    lo, n = 0, len(data)
    while lo < n:
        hi = min(n, lo + SEGMENT)
        while not SPACES[data[hi - 1]]:  # the buffer ends in a line feed
            more = np.nonzero(SPACES[data[hi : hi + SEGMENT]])[0]
            hi = hi + int(more[0]) + 1 if len(more) else min(n, hi + SEGMENT)
        part = data[lo:hi]
        if lower:
            part = LOWER[part]
        space = SPACES[part]
        edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
        first, last = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
        c = prefix_hashes(part)
        with np.errstate(over="ignore"):
            length = (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            hashes.append(mixed(span_hashes(c, first, last) + length))
        at.append(first + lo)
        lo = hi
    where = np.concatenate(at) if at else np.zeros(0, dtype=np.int64)
    owner = np.searchsorted(starts, where, side="right") - 1
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), owner


def sequence_hashes(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of n consecutive words (runs may cross texts)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    factor = np.uint64(0x2545F4914F6CDD1D + 2 * seed)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out = out * factor + words[j : len(words) - n + 1 + j]
        return mixed(out + np.uint64(n + seed))
