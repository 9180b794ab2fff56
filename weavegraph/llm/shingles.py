"""Word and shingle hashes of many texts at once, as numpy arrays."""

from __future__ import annotations

import numpy as np

#: An odd base and its inverse modulo 2**64, for word hashes out of running sums.
BASE = 0x5851F42D4C957F2D
INVERSE = pow(BASE, -1, 1 << 64)
#: Lower-cases A-Z; the white space of the word rule becomes a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c in (9, 10, 11, 12, 13) else c for c in range(256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        out = []
        for b in (BASE, INVERSE):
            table = np.ones(size, dtype=np.uint64)
            done = 1
            while done < size:
                table[done : 2 * done] = table[:done] * np.uint64(pow(b, done, 1 << 64))
                done *= 2
            out.append(table)
        _powers.clear()
        _powers[size] = tuple(out)
    return _powers[size]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one text after the other, and each text's number of words.

    Words are runs of bytes other than space and \\t to \\r; A-Z are lower-cased.
    """
    hashes, _, counts = word_and_start_hashes(texts, 0)
    return hashes, counts


def word_and_start_hashes(texts: list[bytes], start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """word_hashes(), and between them the hashes of the words' first `start` bytes (0: none)."""
    joined = (b" ".join(texts) + b" ").translate(FOLD) if texts else b""
    code = np.frombuffer(joined, dtype=np.uint8)
    if not len(code):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    inside = code != 32
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begin, end = edge[::2], edge[1::2]
    power, inverse = power_tables(len(code) + 1)
    running = np.zeros(len(code) + 1, dtype=np.uint64)
    np.cumsum((code.astype(np.uint64) + np.uint64(1)) * power[: len(code)], out=running[1:])
    hashes = mix((running[end] - running[begin]) * inverse[begin] + (end - begin).astype(np.uint64))
    upto = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    counts = np.diff(np.searchsorted(begin, upto, side="left"), prepend=0)
    if not start:
        return hashes, hashes[:0], counts
    cut = np.minimum(end, begin + start)
    return hashes, mix((running[cut] - running[begin]) * inverse[begin] + (cut - begin).astype(np.uint64)), counts


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: of `width` words, or of the whole text if it has fewer; none of a text without words."""
    words, counts = word_hashes(texts)
    k = np.uint64(0x9E3779B97F4A7C15)
    if len(words) >= width:
        combined = words[: len(words) - width + 1].copy()
        for i in range(1, width):
            combined = combined * k + words[i : len(words) - width + 1 + i]
        combined = mix(combined)
    else:
        combined = np.zeros(0, np.uint64)
    out, at = [], 0
    for n in counts.tolist():
        if n >= width:
            out.append(np.unique(combined[at : at + n - width + 1]))
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for w in words[at : at + n]:
                    whole = whole * k + w
            out.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out
