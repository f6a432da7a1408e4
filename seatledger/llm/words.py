"""Words and word shingles of many texts at once, as 64-bit hashes, in numpy.

A word is a run of ASCII letters and digits and of any characters beyond
ASCII, in lower case; all else separates.  A word's hash is a polynomial over
a random number per byte, taken from running sums, and then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Texts are worked on in runs of about so many characters; longer ones are cut between words.
RUN = 1 << 19
SHINGLE = 5

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_FACTOR = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads close values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_FACTOR))
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(48, 58), *range(97, 123), *range(65, 91), *range(128, 256)]] = True


def _powers(n: int, factor: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(0, 1), _powers(0, 1)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if len(_UP) < n:
        _UP, _DOWN = _powers(n, _FACTOR), _powers(n, pow(_FACTOR, -1, 1 << 64))
    return _UP[:n], _DOWN[:n]


def _hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word."""
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = _IN_WORD[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edge = np.concatenate([[0] if inside[0] else [], edge, [len(data)] if inside[-1] else []]).astype(np.int64)
    starts, ends = edge[::2], edge[1::2]
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), starts


def _cuts(text: str) -> Iterator[str]:
    """A long text in parts that end between words."""
    start = 0
    while len(text) - start > RUN:
        end = min((i for i in (text.find(c, start + RUN) for c in " \n") if i >= 0), default=len(text))
        yield text[start:end]
        start = end
    yield text[start:]


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """The words of each text, in order."""
    out, group, size = [], [], 0

    def flush() -> None:
        if group:
            joined = [t.lower().encode() for t in group]
            hashes, starts = _hashes(b"\n".join(joined))
            ends = np.cumsum([len(b) + 1 for b in joined])
            out.extend(np.split(hashes, np.searchsorted(starts, ends[:-1])))
            group.clear()

    for text in texts:
        if len(text) > RUN:
            flush()
            out.append(np.concatenate([_hashes(part.lower().encode())[0] for part in _cuts(text)]))
            size = 0
            continue
        if size + len(text) > RUN:
            flush()
            size = 0
        group.append(text)
        size += len(text)
    flush()
    return out


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The distinct runs of ``size`` words, sorted; a shorter text is one run of all its words, no words none."""
    if not len(words):
        return np.empty(0, np.uint64)
    size = min(size, len(words))
    run = words[: len(words) - size + 1].copy()
    for k in range(1, size):
        run = mix(run * np.uint64(3) + words[k : len(words) - size + 1 + k])
    return np.unique(run + np.uint64(size))
