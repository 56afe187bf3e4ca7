"""Hashes of word shingles, for many texts at once."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE, GOLDEN = U(0x9E3779B97F4A7C15 | 1), U(0x9E3779B97F4A7C15)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
POSITIONS = np.array([0xD1B54A32D192ED03, 0xABC98388FB8FAC03, 0x8CB92BA72F3D8DD7, 0xF1357AEA2E62A9C5, 0xC13FA9A902A6328F], np.uint64)
# bytes of words in UTF-8 with A-Z lower-cased: digits, a-z, and every byte of a character above ASCII
IN_WORD = np.zeros(256, bool)
IN_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
IN_WORD[128:] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit value of each 64-bit value (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def word_hashes(raw: list[bytes], in_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word of the texts in order, and how many words each text has.

    ``in_word`` tells which bytes belong to words; a line break must not. A word's hash is a
    polynomial over its bytes, from running sums over all bytes.
    """
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    inside = in_word[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    powers = np.empty(len(data), np.uint64)
    powers[0] = 1
    powers[1:] = BASE
    np.multiply.accumulate(powers, out=powers)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + U(1)) * powers, dtype=np.uint64)])
    inverse = np.empty(len(data), np.uint64)
    inverse[0] = 1
    inverse[1:] = BASE_INVERSE
    np.multiply.accumulate(inverse, out=inverse)
    hashes = mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * GOLDEN)
    borders = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.concatenate([[0], np.searchsorted(starts, borders)]))
    return hashes, counts


def shingles(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and the index of the text of each; a shorter text that has
    words is one run."""
    words, counts = word_hashes([t.encode().lower() for t in texts])
    firsts = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(texts)), runs)
    start = np.arange(len(owner)) - np.repeat(np.concatenate([[0], np.cumsum(runs)[:-1]]), runs) + firsts[owner]
    left = counts[owner]
    out = np.repeat(U(size), len(owner)) * GOLDEN
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    for at in range(size):
        has = at < left if size > 1 else np.ones(len(owner), bool)
        word = np.where(has, padded[start + at], GOLDEN)
        out = mixed(out * POSITIONS[at % len(POSITIONS)] + word)
    return out, owner


def multisets(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: hash, number of times, index of the text; by text, then hash."""
    hashes, owner = shingles(texts, size)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return hashes[at], np.diff(np.concatenate([at, [len(hashes)]])), owner[at]
