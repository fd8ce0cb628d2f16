"""Hashes of byte runs and words for many texts at once, with numpy."""

import numpy as np

#: Odd, so that it has an inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
CHUNK_BYTES = 1 << 19
#: Blank bytes (space and 0x09 to 0x0D) and the lower case of A to Z.
BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(x):
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of the hash's base and of its inverse, as many as needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n):
        if len(cls.up) <= n:
            size = max(n + 1, (1 << 19) + 1)
            step = np.full(size, np.uint64(BASE))
            step[0] = 1
            back = np.full(size, np.uint64(pow(BASE, -1, 1 << 64)))
            back[0] = 1
            cls.up, cls.down = np.cumprod(step), np.cumprod(back)


class Tokens:
    """The blank-separated words of some texts: a hash of each word's bytes, A to Z in lower case."""

    def __init__(self, texts):
        data = LOWER[np.frombuffer(b" ".join(texts) + b" ", np.uint8)]
        n = len(data)
        blank = BLANK[data]
        edge = np.flatnonzero(np.diff(np.r_[True, blank].astype(np.int8)))
        self.start, self.stop = edge[::2], edge[1::2]
        Powers.reach(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * Powers.up[:n], out=self.sums[1:])
        self.data = data
        self.hash = mixed((self.sums[self.stop] - self.sums[self.start]) * Powers.down[self.start] + (self.stop - self.start).astype(np.uint64))
        ends = np.cumsum([len(t) + 1 for t in texts])
        #: Words of text k: first[k] to first[k + 1].
        self.first = np.r_[0, np.searchsorted(self.start, ends)]
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))


def in_chunks(texts, size=CHUNK_BYTES):
    """Slices of the list that hold about ``size`` bytes each; a longer text is alone."""
    a = held = 0
    for k, text in enumerate(texts):
        if k > a and held + len(text) > size:
            yield slice(a, k)
            a, held = k, 0
        held += len(text)
    if len(texts) > a:
        yield slice(a, len(texts))
