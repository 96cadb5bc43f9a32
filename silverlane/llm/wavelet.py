"""A wavelet matrix of token ids: bit-planes with rank and select, and its file format.

Plane by plane from the highest bit, ids are split stably into those with bit 0 and those with bit 1. The planes answer
access, rank (how often an id occurs before a place) and select (where its k-th occurrence is) without the ids.

File: magic, a header of four 64-bit numbers (ids, planes, texts, length of the directory), the directory, then the
sections it lists, each a zstd frame: keys of the texts as differences, lengths of the texts, and per plane the counts
of ones before every block of ``BLOCK`` bits and the bits in chunks of ``CHUNK`` bytes. The directory has the length of
every frame and the zeros of every plane, so one lookup reads the directory and a chunk or two of each plane.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Callable

import numpy as np
import zstandard

MAGIC = b"SLWM0002"
BLOCK = 2048
CHUNK = 1 << 14
_WIDTH = BLOCK // 8
_HEADER = struct.Struct("<4q")
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1).astype(np.uint8)


class Plane:
    """Bits of a plane by chunk, how many are zeros, and the ones before each block."""

    def __init__(self, zeros: int, counts: Callable[[], np.ndarray], n_chunks: int, load: Callable[[int], np.ndarray]):
        self.zeros, self._counts, self.n_chunks, self._load = zeros, counts, n_chunks, load
        self._known: tuple[int, np.ndarray] | None = None
        self._ones: np.ndarray | None = None

    @classmethod
    def of(cls, bits: np.ndarray, zeros: int) -> Plane:
        counts = _block_counts(bits)
        return cls(zeros, lambda: counts, -(-len(bits) // CHUNK), lambda k: bits[k * CHUNK : (k + 1) * CHUNK])

    @property
    def counts(self) -> np.ndarray:
        if self._ones is None:
            self._ones = self._counts()
        return self._ones

    def chunk(self, k: int) -> np.ndarray:
        """One chunk; the last one asked for is kept."""
        if self._known is None or self._known[0] != k:
            self._known = k, self._load(k)
        return self._known[1]

    def bits(self) -> np.ndarray:
        parts = [self._load(k) for k in range(self.n_chunks)]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint8)

    def look(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bit at each place (0 behind the end), and the ones before it."""
        out, ones = np.zeros(len(at), dtype=np.uint8), np.zeros(len(at), dtype=np.int64)
        chunk_of = at // (8 * CHUNK)
        order = np.argsort(chunk_of, kind="stable")
        bounds = np.flatnonzero(np.diff(chunk_of[order])) + 1
        inside = np.arange(_WIDTH)[None, :]
        for group in np.split(order, bounds):
            if not len(group):
                continue
            k = int(chunk_of[group[0]])
            bits = self.chunk(k) if k < self.n_chunks else np.zeros(0, dtype=np.uint8)
            padded = np.concatenate([bits, np.zeros(_WIDTH + 1, dtype=np.uint8)])
            for low in range(0, len(group), 4096):  # bounded memory for many places
                part = group[low : low + 4096]
                place = at[part] - k * 8 * CHUNK
                block = place // BLOCK
                rows = padded[np.minimum(block[:, None] * _WIDTH + inside, len(padded) - 1)]
                rest = (place - block * BLOCK)[:, None] - 8 * inside
                mask = (0xFF00 >> np.clip(rest, 0, 8)) & 0xFF
                ones[part] = self.counts[at[part] // BLOCK] + _ONES[rows & mask.astype(np.uint8)].sum(1, dtype=np.int64)
                byte = padded[np.minimum(place >> 3, len(padded) - 1)]
                out[part] = (byte >> (7 - (place & 7)).astype(np.uint8)) & 1
        return out, ones


class WaveletMatrix:
    """``planes`` from the highest bit on."""

    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.planes = n, planes

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        planes, current = [], ids
        for level in range(width - 1, -1, -1):
            ones = ((current >> current.dtype.type(level)) & current.dtype.type(1)).astype(bool)
            zeros = len(ones) - int(np.count_nonzero(ones))
            planes.append(Plane.of(np.packbits(ones), zeros))
            following = np.empty_like(current)
            following[zeros:] = current[ones]
            np.logical_not(ones, out=ones)
            following[:zeros] = current[ones]
            current = following
        return cls(len(ids), planes)

    def access(self, at) -> np.ndarray:
        """Ids at places."""
        at = np.asarray(at, dtype=np.int64).copy()
        out = np.zeros(len(at), dtype=np.int64)
        for plane in self.planes:
            bit, ones = plane.look(at)
            out = (out << 1) | bit
            at = np.where(bit == 1, plane.zeros + ones, at - ones)
        return out

    def _descend(self, value: int, place: int) -> tuple[int, int]:
        """Where the run of an id begins and where a place of it ends up, below the last plane."""
        begin, at = 0, place
        for level, plane in enumerate(self.planes):
            _, ones = plane.look(np.array([begin, at]))
            if value >> (len(self.planes) - 1 - level) & 1:
                begin, at = plane.zeros + int(ones[0]), plane.zeros + int(ones[1])
            else:
                begin, at = begin - int(ones[0]), at - int(ones[1])
        return begin, at

    def rank(self, value: int, place: int) -> int:
        """Occurrences of an id before a place."""
        if not 0 <= value < 1 << len(self.planes):
            return 0
        begin, at = self._descend(value, min(max(place, 0), self.n))
        return at - begin

    def count(self, value: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of an id from ``low`` up to ``high``."""
        return max(0, self.rank(value, self.n if high is None else high) - self.rank(value, low))

    def select(self, value: int, k: int) -> int:
        """Place of the k-th occurrence (from 0) of an id, -1 if there are not so many."""
        if k < 0 or k >= self.count(value):
            return -1
        return int(self._ascend(value, np.array([self._descend(value, 0)[0] + k]))[0])

    def _ascend(self, value: int, at: np.ndarray) -> np.ndarray:
        for level in range(len(self.planes) - 1, -1, -1):
            plane, one = self.planes[level], value >> (len(self.planes) - 1 - level) & 1
            at = np.array([_select(plane, int(k) - plane.zeros if one else int(k), bool(one), self.n) for k in at], dtype=np.int64)
        return at

    def occurrences(self, value: int) -> list[int]:
        """All places of an id."""
        n = self.count(value)
        return self._ascend(value, self._descend(value, 0)[0] + np.arange(n)).tolist() if n else []

    def decode(self, dtype=np.uint16) -> np.ndarray:
        """All ids in order, from the lowest plane up."""
        current = np.zeros(self.n, dtype=dtype)
        for level, plane in enumerate(reversed(self.planes)):
            ones = np.unpackbits(plane.bits(), count=self.n).view(bool)
            out = np.empty_like(current)
            out[ones] = current[plane.zeros :] | dtype(1 << level)
            np.logical_not(ones, out=ones)
            out[ones] = current[: plane.zeros]
            current = out
        return current


def _block_counts(bits: np.ndarray) -> np.ndarray:
    padded = np.zeros((len(bits) // _WIDTH + 1) * _WIDTH, dtype=np.uint8)
    padded[: len(bits)] = bits
    return np.concatenate([[0], np.cumsum(np.bitwise_count(padded).reshape(-1, _WIDTH).sum(1, dtype=np.int64))]).astype(np.uint32)


def _select(plane: Plane, k: int, one: bool, n: int) -> int:
    """Place of the k-th one or zero of a plane."""
    counts = plane.counts
    before = counts.astype(np.int64) if one else np.arange(len(counts)) * BLOCK - counts
    block = int(np.searchsorted(before, k, side="right")) - 1
    in_chunk = block * _WIDTH % CHUNK
    bits = plane.chunk(block * _WIDTH // CHUNK)[in_chunk : in_chunk + _WIDTH]
    inside = np.unpackbits(bits)[: n - block * BLOCK]
    return block * BLOCK + int(np.flatnonzero(inside == one)[k - int(before[block])])


def to_bytes(matrix: WaveletMatrix, keys: np.ndarray, lengths: np.ndarray) -> bytes:
    pack = zstandard.ZstdCompressor(level=1).compress
    frames = [pack(np.diff(keys.astype("<i8"), prepend=np.int64(0)).tobytes()), pack(lengths.astype("<i8").tobytes())]
    for plane in matrix.planes:
        frames.append(pack(plane.counts.astype("<u4").tobytes()))
        frames.extend(pack(plane.chunk(k).tobytes()) for k in range(plane.n_chunks))
    directory = pack(np.array([p.zeros for p in matrix.planes] + [len(f) for f in frames], dtype="<i8").tobytes())
    header = _HEADER.pack(matrix.n, len(matrix.planes), len(keys), len(directory))
    return b"".join([MAGIC, header, directory, *frames])


class TokenFile:
    """A token file that is read by parts: ``source`` has seek and read."""

    def __init__(self, source):
        head = source.read(len(MAGIC) + _HEADER.size)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError("not a token file")
        self._source = source
        n, width, self.n_texts, size = _HEADER.unpack(head[len(MAGIC) :])
        directory = np.frombuffer(self._frame(len(head), size), dtype="<i8")
        sizes = directory[width:]
        begins = len(head) + size + np.cumsum(sizes) - sizes
        n_chunks = -(-((n + 7) // 8) // CHUNK)

        def frame(i: int, dtype) -> np.ndarray:
            return np.frombuffer(self._frame(int(begins[i]), int(sizes[i])), dtype=dtype)

        def plane(level: int) -> Plane:
            first = 2 + level * (1 + n_chunks)
            return Plane(int(directory[level]), lambda: frame(first, "<u4"), n_chunks, lambda k: frame(first + 1 + k, np.uint8))

        self.keys, self.lengths = np.cumsum(frame(0, "<i8")), frame(1, "<i8")
        self.matrix = WaveletMatrix(n, [plane(level) for level in range(width)])

    def _frame(self, at: int, size: int) -> bytes:
        self._source.seek(at)
        return zstandard.ZstdDecompressor().decompress(self._source.read(size))


def from_bytes(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """Matrix, keys and lengths of the texts in a file."""
    file = TokenFile(io.BytesIO(data))
    return file.matrix, file.keys, file.lengths
