"""Hashed n-grams of whole Arrow batches of texts, by numpy only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: White space bytes; ASCII punctuation. Every other byte belongs to a word.
SPACE = [0x20, *range(0x09, 0x0E)]
PUNCTUATION = [*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]
BASE = 0x9E3779B97F4A7C15  # odd, so invertible modulo 2^64


def byte_classes() -> np.ndarray:
    kinds = np.ones(256, np.uint8)
    kinds[SPACE], kinds[PUNCTUATION] = 0, 2
    return kinds


def buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null texts are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class TokenHasher:
    """64-bit hashes of tokens (runs of word bytes or of punctuation, A-Z
    lowered) of a batch of texts. A token's hash is a polynomial of its bytes, taken
    from prefix sums, so no Python runs per token."""

    def __init__(self) -> None:
        self.kinds = byte_classes()
        self.codes = np.arange(1, 257, dtype=np.uint64)  # never zero
        self.codes[0x41:0x5B] += np.uint64(32)
        self.inverse = np.uint64(pow(BASE, -1, 1 << 64))
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _room(self, n: int) -> None:
        if len(self.powers) < n:
            self.powers, self.inverses = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]))
                                          for b in (np.uint64(BASE), self.inverse))

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each token, first token of each text and the end); ``starts``
        then has the tokens' first bytes."""
        self.starts = np.zeros(0, np.int64)
        if not len(data):
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        self._room(len(data) + 1)
        kinds = self.kinds[data]
        fresh = np.empty(len(data), bool)
        fresh[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=fresh[1:])
        fresh[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(fresh)
        ends = np.append(starts[1:], len(data))
        word = kinds[starts] > 0
        starts, ends = starts[word], ends[word]
        self.starts = starts
        sums = np.zeros(len(data) + 1, np.uint64)
        np.multiply(self.codes[data], self.powers[:len(data)], out=sums[1:])
        np.cumsum(sums, out=sums)
        h = mixed((sums[ends] - sums[starts]) * self.inverses[starts])
        return h, np.searchsorted(starts, offsets)

    def ngram_buckets(self, texts: pa.Array, buckets: int, span: int = 1 << 20):
        """Yields (first text, end text, buckets of unigrams and bigrams, owner text of each)."""
        data, offsets = buffer(texts)
        a = 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + span, "right")) - 1)
            h, first = self.tokens(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            owner = np.repeat(np.arange(b - a), np.diff(first))
            pair = owner[1:] == owner[:-1]
            bigram = mixed(h[:-1] * np.uint64(3) + h[1:])[pair] if len(h) else h
            both = np.concatenate([h, bigram]) % np.uint64(buckets)
            yield a, b, both.astype(np.int64), np.concatenate([owner, owner[1:][pair]])
            a = b
