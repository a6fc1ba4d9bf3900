"""Words of many texts at once, as 64-bit hashes.

A text is scanned as bytes: upper-case A-Z is lowered, a word is a run of the
given word bytes. A word's hash is a polynomial over its bytes (from running
sums, so no loop over words), finished with a bit mixer. Work is done in blocks
of about a megabyte; a longer text is cut between words, so memory stays small
whatever the length of a text, and each text is read whole.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1 << 20
BASE = 0x9E3779B97F4A7C15
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: [0-9a-z] and every non-ASCII byte (of the lowered text)
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: everything but space and \t \n \v \f \r
NONSPACE = np.ones(256, bool)
NONSPACE[9:14] = NONSPACE[32] = False


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n in _POWERS:
        return _POWERS[n]
    step = np.full(n, BASE, np.uint64)
    back = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    step[0] = back[0] = 1
    found = np.cumprod(step), np.cumprod(back)
    if n == BLOCK + 1:  # a larger block (one giant word) is not kept
        _POWERS[n] = found
    return found


def _hash_block(buf: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of one block and where each word starts."""
    low = LOWER[buf]
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = word[low]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[0::2], edges[1::2]
    size = BLOCK + 1 if len(buf) <= BLOCK + 1 else 1 << int(len(buf)).bit_length()
    up, down = _powers(size)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h ^ (ends - starts).astype(np.uint64)), starts


def _cuts(text: bytes, word: np.ndarray):
    """Pieces of a long text, cut after a non-word byte."""
    at = 0
    while len(text) - at > BLOCK:
        end = at + BLOCK
        while True:
            gaps = np.flatnonzero(~word[LOWER[np.frombuffer(text, np.uint8, min(BLOCK, len(text) - end + BLOCK),
                                                             end - BLOCK)]])
            if len(gaps) or end >= len(text):
                break
            end = min(end + BLOCK, len(text))
        end = end - BLOCK + int(gaps[-1]) + 1 if len(gaps) else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def hash_words(texts: list[bytes], word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts`` in order, and offsets: text i has the
    words ``offsets[i]:offsets[i + 1]``."""
    counts = np.zeros(len(texts) + 1, np.int64)
    out, group, owner, size = [], [], [], 0

    def flush():
        nonlocal size
        if group:
            h, starts = _hash_block(np.frombuffer(b" ".join(group), np.uint8), word)
            begin = np.cumsum([0] + [len(g) + 1 for g in group])
            np.add.at(counts, np.array(owner) + 1, np.diff(np.searchsorted(starts, begin)))
            out.append(h)
            group.clear(), owner.clear()
            size = 0

    for i, t in enumerate(texts):
        for piece in [t] if len(t) <= BLOCK else _cuts(t, word):
            if size + len(piece) + 1 > BLOCK:
                flush()
            group.append(piece)
            owner.append(i)
            size += len(piece) + 1
    flush()
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.cumsum(counts)


def hash_word(word: str) -> int:
    return int(hash_words([word.encode()], NONSPACE)[0][0])


def windows(h: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``k`` words and the offsets by text (a text of
    fewer words has none)."""
    n = np.diff(offsets)
    if len(h) < k:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    acc = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        acc = mix(acc * np.uint64(3) + h[j: len(h) - k + 1 + j])
    room = np.repeat(offsets[1:], n)[: len(acc)] - np.arange(len(acc))
    w = np.maximum(n - k + 1, 0)
    return acc[room >= k], np.concatenate([[0], np.cumsum(w)])
