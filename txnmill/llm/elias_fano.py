"""Elias-Fano code of a rising sequence, with select.

``n`` numbers up to ``u`` take about ``2 + log2(u / n)`` bits each. The low bits of each number
lie packed; the high parts are unary in a bit array, where number ``i`` sets bit
``(value >> low_bits) + i``. ``select`` finds the ``i``-th set bit from a table of every 256th.
"""

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQB7x")  # numbers, words of the high bits, low bits


def encode(values: np.ndarray) -> bytes:
    """Bytes of a sequence of whole numbers that never falls."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if not n:
        return _HEAD.pack(0, 0, 0)
    ratio = int(values[-1]) // n
    low_bits = max(0, ratio.bit_length() - 1)
    place = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    words = int(place[-1]) // 64 + 1
    high = np.zeros(words * 64, np.uint8)
    high[place] = 1
    shifts = np.arange(low_bits, dtype=np.uint64)
    low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return b"".join(
        (
            _HEAD.pack(n, words, low_bits),
            np.packbits(high, bitorder="little").tobytes(),
            place[::SAMPLE].astype("<u8").tobytes(),
            np.packbits(low.ravel(), bitorder="little").tobytes(),
        )
    )


class Sequence:
    """Reader of an encoded sequence; keeps it encoded."""

    def __init__(self, data: bytes | memoryview):
        self.n, words, self.low_bits = _HEAD.unpack_from(data)
        at = _HEAD.size
        self.high = np.frombuffer(data, "<u8", words, at)
        at += 8 * words
        samples = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(data, "<u8", samples, at)
        at += 8 * samples
        self.low = np.frombuffer(data, np.uint8, -(-self.n * self.low_bits // 8), at)
        self.end = at + len(self.low)

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """The ``i``-th number: one sample, then a walk over at most a few words."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place = int(self.samples[i // SAMPLE])
        left, word = i % SAMPLE, place // 64
        bits = int(self.high[word]) >> (place % 64) << (place % 64)
        while (count := bits.bit_count()) <= left:
            left -= count
            word += 1
            bits = int(self.high[word])
        for _ in range(left):
            bits &= bits - 1
        place = word * 64 + (bits & -bits).bit_length() - 1
        return (place - i << self.low_bits) | self._low(i)

    def select(self, numbers: np.ndarray) -> np.ndarray:
        """The numbers at these places. Each search starts at its sample; those that are not done
        after a word go on to the next together."""
        numbers = np.asarray(numbers, np.int64)
        if not len(numbers):
            return np.empty(0, np.int64)
        if numbers.min() < 0 or numbers.max() >= self.n:
            raise IndexError(numbers)
        place = self.samples[numbers // SAMPLE].astype(np.int64)
        word, left = place // 64, numbers % SAMPLE
        skip = (place % 64).astype(np.uint64)
        bits = self.high[word] >> skip << skip
        going = np.arange(len(numbers))
        while len(going):
            count = np.bitwise_count(bits[going]).astype(np.int64)
            going, count = going[count <= left[going]], count[count <= left[going]]
            left[going] -= count
            word[going] += 1
            bits[going] = self.high[word[going]]
        return (word * 64 + _bit_of(bits, left) - numbers << self.low_bits) | self._lows(numbers)

    def _lows(self, numbers: np.ndarray) -> np.ndarray:
        """Low bits of the numbers at these places, each from the nine bytes that may hold them."""
        first = numbers * self.low_bits
        padded = np.concatenate([self.low, np.zeros(9, np.uint8)])
        low = np.zeros(len(numbers), np.uint64)
        shift = (first % 8).astype(np.uint64)
        for k in range(8):
            low |= padded[first // 8 + k].astype(np.uint64) << np.uint64(8 * k)
        low >>= shift
        ninth = padded[first // 8 + 8].astype(np.uint64)
        low |= np.where(shift > 0, ninth << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return (low & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        first = i * self.low_bits
        last = first + self.low_bits
        raw = int.from_bytes(self.low[first // 8 : -(-last // 8)].tobytes(), "little")
        return raw >> (first % 8) & ((1 << self.low_bits) - 1)

    def all(self) -> np.ndarray:
        """Every number, by one pass over the bits."""
        high = np.unpackbits(self.high.view(np.uint8), bitorder="little")
        top = np.flatnonzero(high)[: self.n] - np.arange(self.n)
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits]
        low = bits.reshape(self.n, self.low_bits).astype(np.int64) << np.arange(self.low_bits)
        return (top << self.low_bits) + low.sum(axis=1)


def _bit_of(bits: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Place of the set bit in each word that has ``left`` set bits below it, by halving."""
    bits, left = bits.copy(), left.copy()
    place = np.zeros(len(bits), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(bits & np.uint64((1 << half) - 1)).astype(np.int64)
        above = left >= below
        left[above] -= below[above]
        bits[above] >>= np.uint64(half)
        place[above] += half
    return place
