"""A wavelet matrix over token ids, kept in one compressed block of bytes.

The ids of a shard are cut into bit-planes, the highest bit first; after each plane the ids are dealt
stably, those with a 0 before those with a 1. With the number of ones before any place of a plane
(rank) and the place of its k-th one or zero (select), an id at a place, the number of times an id
occurs in a range, and the places where it occurs are found by one step per plane.

A plane is stored in blocks of ``BLOCK`` bits. Each block is compressed by itself and knows the ones
before it, so a query opens the few blocks it touches and nothing else.

Layout, little-endian: magic, n (u64), planes (u64), blocks per plane (u64); zeros per plane (u64);
per plane and block the ones before it (u64) and the end of its bytes (u64); the blocks' bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from txnrisk.llm.common import by_value

MAGIC = b"WVMX0001"
#: Bits per block of a plane, a multiple of 8.
BLOCK = 1 << 15


def build(ids: np.ndarray) -> bytes:
    """The file of a sequence of ids (whole numbers from 0 to 2^32 - 1), which may be empty."""
    ids = np.asarray(ids)
    n = len(ids)
    planes = int(ids.max()).bit_length() if n else 0
    blocks = -(-n // BLOCK)
    now = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    zeros, ones_before, ends, parts, at = [], [], [], [], 0
    for plane in reversed(range(planes)):
        bit = (now & now.dtype.type(1 << plane)) != 0
        packed = np.packbits(bit)
        starts = np.arange(0, len(packed), BLOCK // 8)
        ones = np.cumsum(np.add.reduceat(np.bitwise_count(packed), starts, dtype=np.int64))
        for start in starts.tolist():
            parts.append(pa.compress(packed[start : start + BLOCK // 8], codec="zstd", asbytes=True))
            at += len(parts[-1])
            ends.append(at)
        ones_before += [0, *ones[:-1].tolist()]
        zeros.append(n - int(ones[-1]))
        now = now[np.concatenate([np.flatnonzero(~bit), np.flatnonzero(bit)])]  # faster than by masks
    head = np.array([n, planes, blocks, *zeros, *ones_before, *ends], dtype="<u8")
    return b"".join([MAGIC, head.tobytes(), *parts])


class Wavelet:
    """Answers from a file's bytes; blocks are unpacked when they are first needed."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet file")
        self.n, self.planes, self.blocks = (int(x) for x in np.frombuffer(data, "<u8", 3, 8))
        count = self.planes * self.blocks
        head = np.frombuffer(data, "<u8", self.planes + 2 * count, 32).astype(np.int64)
        self.zeros = head[: self.planes]
        self.before = head[self.planes : self.planes + count].reshape(self.planes, self.blocks)
        self.ends = head[self.planes + count :]
        self.body = memoryview(data)[32 + 8 * len(head) :]
        self._open: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def __len__(self) -> int:
        return self.n

    def _bytes(self, plane: int, block: int) -> bytes:
        k = plane * self.blocks + block
        bits = min(BLOCK, self.n - block * BLOCK)
        data = self.body[int(self.ends[k - 1]) if k else 0 : int(self.ends[k])]
        return pa.decompress(data, decompressed_size=-(-bits // 8), codec="zstd", asbytes=True)

    def _block(self, plane: int, block: int) -> tuple[np.ndarray, np.ndarray]:
        """A block's bits, and the ones before each of them and after the last."""
        found = self._open.get((plane, block))
        if found is None:
            size = min(BLOCK, self.n - block * BLOCK)
            bits = np.unpackbits(np.frombuffer(self._bytes(plane, block), np.uint8), count=size)
            found = bits, np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])
            if len(self._open) > 256:
                self._open.clear()
            self._open[plane, block] = found
        return found

    def _rank(self, plane: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per place (0 to n) the ones before it, and the bit there (0 at n)."""
        ones, bit = np.empty(len(places), np.int64), np.zeros(len(places), np.int64)
        which = np.minimum(places // BLOCK, max(self.blocks - 1, 0))
        for block in np.unique(which).tolist():
            mine = which == block
            bits, before = self._block(plane, block)
            at = places[mine] - block * BLOCK
            ones[mine] = before[at] + self.before[plane, block]
            inside = at < len(bits)
            bit[mine] = np.where(inside, bits[np.minimum(at, len(bits) - 1)], 0)
        return ones, bit

    def _select(self, plane: int, bit: int, order: np.ndarray) -> np.ndarray:
        """The place of the one or zero with so many like it before."""
        before = self.before[plane]
        if not bit:
            before = np.arange(self.blocks) * BLOCK - before
        which = np.searchsorted(before, order, side="right") - 1
        out = np.empty(len(order), np.int64)
        for block in np.unique(which).tolist():
            mine = which == block
            places = np.flatnonzero(self._block(plane, block)[0] == bit)
            out[mine] = places[order[mine] - before[block]] + block * BLOCK
        return out

    def access(self, places) -> np.ndarray:
        """The ids at the places."""
        places = np.array(places, dtype=np.int64, ndmin=1)
        out = np.zeros(len(places), np.int64)
        for plane in range(self.planes):
            ones, bit = self._rank(plane, places)
            places = np.where(bit == 1, self.zeros[plane] + ones, places - ones)
            out = out << 1 | bit
        return out

    def _narrow(self, token: int, bounds: np.ndarray) -> np.ndarray | None:
        """Where the bounds end up behind the last plane if only this id is followed."""
        if token < 0 or token >> self.planes:
            return None
        for plane in range(self.planes):
            ones, _ = self._rank(plane, bounds)
            bounds = self.zeros[plane] + ones if token >> (self.planes - 1 - plane) & 1 else bounds - ones
        return bounds

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often the id occurs from ``low`` up to before ``high``."""
        bounds = self._narrow(token, np.array([low, self.n if high is None else high], np.int64))
        return 0 if bounds is None else int(bounds[1] - bounds[0])

    def places(self, token: int, low: int = 0, high: int | None = None) -> np.ndarray:
        """The places of the id from ``low`` up to before ``high``, in order."""
        bounds = self._narrow(token, np.array([low, self.n if high is None else high], np.int64))
        if bounds is None or bounds[0] == bounds[1]:
            return np.empty(0, np.int64)
        at = np.arange(bounds[0], bounds[1])
        for plane in reversed(range(self.planes)):
            bit = token >> (self.planes - 1 - plane) & 1
            at = self._select(plane, bit, at - self.zeros[plane] if bit else at)
        return at

    def all(self) -> np.ndarray:
        """Every id in order: the planes' deals undone from the last to the first."""
        now = np.zeros(self.n, np.uint16 if self.planes <= 16 else np.uint32)
        for plane in reversed(range(self.planes)):
            packed = b"".join(self._bytes(plane, block) for block in range(self.blocks))
            bit = np.unpackbits(np.frombuffer(packed, np.uint8), count=self.n).view(bool)
            dealt, now = now, np.empty_like(now)
            now[np.flatnonzero(~bit)] = dealt[: self.zeros[plane]]
            now[np.flatnonzero(bit)] = dealt[self.zeros[plane] :] | now.dtype.type(1 << (self.planes - 1 - plane))
        return now.astype(np.uint32)


by_value(__name__)
