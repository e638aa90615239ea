"""CRC-32C of many byte strings at once, masked as length-delimited records carry it."""

from __future__ import annotations

import numpy as np

# The reflected Castagnoli polynomial, and the constant of the mask.
POLYNOMIAL, MASK = np.uint32(0x82F63B78), np.uint32(0xA282EAD8)

CHUNK = 64
U = np.uint32


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & U(1), (table >> U(1)) ^ POLYNOMIAL, table >> U(1))
    return table


def _pair_tables(byte: np.ndarray) -> np.ndarray:
    """What each pair of bytes adds to the remainder of its chunk, by place in the chunk."""
    places = [byte]
    for _ in range(CHUNK - 1):
        last = places[-1]
        places.append((last >> U(8)) ^ byte[last & U(0xFF)])
    # A little-endian pair has its earlier byte, which more bytes follow, in the low half.
    return np.stack([
        (places[CHUNK - 2 - 2 * j][:, None] ^ places[CHUNK - 1 - 2 * j][None, :]).ravel() for j in range(CHUNK // 2)
    ])


class Crc32c:
    """Remainders are linear, so all chunks of all strings go through the tables together.

    A string is filled up in front to whole chunks (leading zeros change nothing). The remainder of a chunk moves over
    the chunks behind it by operators for 1, 2, 4, ... chunks; those of one string are then added up.
    """

    def __init__(self) -> None:
        self.byte = _byte_table()
        self.pairs = _pair_tables(self.byte)
        ones = U(1) << np.arange(32, dtype=np.uint32)
        for _ in range(CHUNK):
            ones = (ones >> U(8)) ^ self.byte[ones & U(0xFF)]
        self.steps = [self._tables(ones)]
        self.ones = ones

    @staticmethod
    def _tables(ones: np.ndarray) -> np.ndarray:
        """An operator given by the images of the 32 bits, as a table for each byte of its argument."""
        out = np.zeros((4, 256), dtype=np.uint32)
        values = np.arange(256, dtype=np.uint32)
        for bit in range(32):
            out[bit // 8] ^= np.where(values >> U(bit % 8) & U(1), ones[bit], U(0))
        return out

    @staticmethod
    def _apply(tables: np.ndarray, x: np.ndarray) -> np.ndarray:
        return tables[0][x & U(0xFF)] ^ tables[1][x >> U(8) & U(0xFF)] ^ tables[2][x >> U(16) & U(0xFF)] ^ tables[3][x >> U(24)]

    def of(self, strings: list[bytes]) -> np.ndarray:
        """The checksum of each string; strings have four bytes or more."""
        if not strings:
            return np.zeros(0, dtype=np.uint32)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        if sizes.min() < 4:
            raise ValueError("strings of under four bytes")
        chunks = -(-sizes // CHUNK)
        stops = np.cumsum(chunks)
        data = np.zeros(int(stops[-1]) * CHUNK, dtype=np.uint8)
        for string, size, stop in zip(strings, sizes.tolist(), (stops * CHUNK).tolist()):
            data[stop - size:stop] = np.frombuffer(string, np.uint8)
            data[stop - size:stop - size + 4] ^= np.uint8(0xFF)  # the remainder starts with all bits set
        pairs = data.view("<u2").reshape(-1, CHUNK // 2)
        left = np.zeros(len(pairs), dtype=np.uint32)
        for j, table in enumerate(self.pairs):
            left ^= table[pairs[:, j]]
        behind = np.repeat(stops, chunks) - 1 - np.arange(len(left))
        for level in range(int(behind.max()).bit_length()):
            if level == len(self.steps):
                self.ones = self._apply(self.steps[-1], self.ones)
                self.steps.append(self._tables(self.ones))
            far = np.flatnonzero(behind >> level & 1)
            left[far] = self._apply(self.steps[level], left[far])
        return np.bitwise_xor.reduceat(left, stops - chunks) ^ U(0xFFFFFFFF)

    def masked(self, strings: list[bytes]) -> np.ndarray:
        """Checksums turned right by 15 bits, plus a constant, so that a checksum of data with checksums is no special case."""
        x = self.of(strings)
        return ((x >> U(15)) | (x << U(17))) + MASK
