"""Vectorised text kernels shared by the text operators of this subpackage.

Texts are joined into byte buffers of bounded size and hashed with numpy: one pass over the bytes per
step, no Python loop per word. Long texts get a buffer of their own, so nothing is ever cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_BYTES = 1 << 18
_MUL = np.uint64(0x9E3779B97F4A7C15)
_P = 0xD6E8FEB86659FD93  # odd, hence invertible modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)
_BYTE = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix64(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit integers that spreads every input bit."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _pow(base: int, n: int, key: str) -> np.ndarray:
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.ones(size, dtype=np.uint64)
        have[1:] = np.uint64(base)
        np.multiply.accumulate(have, out=have)
        if size <= 4 * CHUNK_BYTES:
            _powers[key] = have
    return have[:n]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES, max_texts: int = 4096) -> Iterator[tuple[int, int]]:
    """Ranges of texts that together stay within ``limit`` bytes; a longer text forms its own range."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) + 1 > limit or i - start >= max_texts):
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


def class_table(kind: str) -> np.ndarray:
    """``space``: words are runs of bytes that are not ASCII white space.
    ``word``: words are runs of ASCII letters, digits and all bytes of non-ASCII characters, but for punctuation and spaces."""
    table = np.ones(256, dtype=bool)
    if kind == "space":
        table[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = False
    else:
        table[:128] = False
        for a, b in ((48, 58), (65, 91), (97, 123)):
            table[a:b] = True
    return table


_TABLES = {k: class_table(k) for k in ("space", "word")}
#: Scripts written without spaces between words (Thai, Lao, Burmese, Khmer, kana, Chinese characters): each character is a word.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
#: Punctuation and spaces of Unicode's general, CJK and full-width blocks, which separate words of kind ``word``.
_SEPARATORS = ((0x2000, 0x206F), (0x3000, 0x303F), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
_LATIN_LETTERS = (0xAA, 0xB5, 0xBA)  # the letters among U+00A0 to U+00BF


def _within(code: np.ndarray, ranges) -> np.ndarray:
    out = np.zeros(len(code), dtype=bool)
    for a, b in ranges:
        out |= (code >= a) & (code <= b)
    return out


def spans(buffer: np.ndarray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of the buffer. Characters of unspaced scripts are words of their own."""
    inside = np.zeros(len(buffer) + 2, dtype=bool)
    inside[1:-1] = _TABLES[kind][buffer]
    if kind == "word" and len(at := np.flatnonzero(buffer[:-1] == 0xC2)):
        low = buffer[at + 1]
        at = at[(low < 0xC0) & ~np.isin(low, _LATIN_LETTERS)]
        inside[at + 1] = inside[at + 2] = False
    lead = np.flatnonzero(buffer >= 0xE0)
    solo = size = lead[:0]
    if len(lead):
        padded = np.concatenate((buffer, np.zeros(3, np.uint8)))
        b = [padded[lead + i].astype(np.uint32) for i in range(4)]
        four = b[0] >= 0xF0
        tail = (b[1] & 63) << 6 | b[2] & 63
        code = np.where(four, (b[0] & 7) << 18 | tail << 6 | b[3] & 63, (b[0] & 15) << 12 | tail)
        own = _within(code, UNSPACED)
        solo, size = lead[own], np.where(four, 4, 3)[own]
        if kind == "word":
            for at in lead[_within(code, _SEPARATORS)]:
                inside[at + 1 : at + 4] = False
    begins = inside[1:] & ~inside[:-1]
    if len(solo):
        begins[solo] = True
        begins[solo + size] |= inside[1:][solo + size]
    return np.flatnonzero(begins), np.flatnonzero(inside[:-1] & (~inside[1:] | begins))


def hash_prefix(buffer: np.ndarray) -> np.ndarray:
    """Sums of a polynomial over the bytes before each place, modulo 2**64."""
    prefix = np.zeros(len(buffer) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buffer] * _pow(_P, len(buffer), "p"), out=prefix[1:])
    return prefix


def prefix_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of buffer[start:end]; equal bytes have equal hashes wherever they stand."""
    return mix64((prefix[end] - prefix[start]) * _pow(_P_INV, len(prefix), "i")[start])


def span_hashes(buffer: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return prefix_hashes(hash_prefix(buffer), start, end)


def word_prefix(words: np.ndarray) -> np.ndarray:
    """Sums of a polynomial over the word hashes before each place: the hash of any run of words is a difference of two of them."""
    prefix = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * _pow(_P, len(words), "p"), out=prefix[1:])
    return prefix


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Rolling hashes of every n consecutive words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    at = np.arange(m)
    return prefix_hashes(word_prefix(words), at, at + n)


def encode(texts, lower: bool = False) -> list[bytes]:
    """UTF-8 bytes of the texts; null counts as empty, lone surrogates are replaced."""
    return [b"" if not isinstance(t, str) else (t.lower() if lower else t).encode("utf-8", "replace") for t in texts]


def word_batches(texts: list[bytes], kind: str):
    """Yield (first, last, buffer, word start, word end, word hash, bounds): the words of text i of a batch are
    those from bounds[i - first] to bounds[i - first + 1]."""
    for a, b in chunks(texts):
        joined = b"\n".join(texts[a:b]) + b"\n"
        buffer = np.frombuffer(joined, dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts[a:b]])
        start, end = spans(buffer, kind)
        bounds = np.concatenate(([0], np.searchsorted(start, ends)))
        yield a, b, buffer, start, end, span_hashes(buffer, start, end), bounds


def shingle_sets(texts: list[bytes], n: int, kind: str = "word") -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word n-grams; a text of fewer than n words has one
    shingle, all its words, and a text without words none."""
    for a, b, _, _, _, words, bounds in word_batches(texts, kind):
        grams = gram_hashes(words, n)
        for i in range(b - a):
            lo, hi = int(bounds[i]), int(bounds[i + 1])
            if hi - lo >= n:
                yield np.unique(grams[lo : hi - n + 1])
            elif hi > lo:
                yield gram_hashes(words[lo:hi], hi - lo)
            else:
                yield np.zeros(0, dtype=np.uint64)
