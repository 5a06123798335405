"""Patched frame-of-reference file of unsigned 32-bit ids.

Layout, little-endian:

    header     b"PFOR", version u32, block length u32, percentile u32
    payloads   per block, 8-byte aligned: values less the block's minimum,
               packed at the block's width into 64-bit words
    patches    per block in order: position u16 and full value less minimum u32
               of the values that don't fit the width
    index      per block: payload start u64, patch start u64 (counted in
               patches), minimum u32, count u16, width u8, padding u8
    documents  per document: key i64, key-is-null u8, id count u64
    trailer    block count u64, patch count u64, document count u64, id count u64, b"PFOR"

The width is the number of bits that a given percentile of a block's values
needs. Every block can be decoded alone through the index.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

BLOCK = 256
PERCENTILE = 90
#: Blocks that are packed or unpacked together.
BATCH = 2_048

INDEX = np.dtype([("at", "<u8"), ("patch", "<u8"), ("low", "<u4"), ("count", "<u2"), ("width", "u1"), ("pad", "u1")])
PATCH = np.dtype([("at", "<u2"), ("value", "<u4")])
DOCUMENT = np.dtype([("key", "<i8"), ("null", "u1"), ("n_ids", "<u8")])
_HEADER, _TRAILER = "<4sIII", "<QQQQ4s"
MAGIC = b"PFOR"


#: Bits that each number below 2^16 needs.
_BIT_LENGTHS = np.frexp(np.arange(1 << 16, dtype=np.float64))[1].astype(np.uint8)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each 32-bit value needs."""
    high = values >> 16
    if not high.any():
        return _BIT_LENGTHS[values]
    return np.where(high > 0, 16 + _BIT_LENGTHS[high], _BIT_LENGTHS[values & 0xFFFF])


def _pack(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2^width as rows of 64-bit words."""
    words = np.zeros((BLOCK * width // 64, len(rows)), "<u8")
    columns = np.ascontiguousarray(rows.T).astype(np.uint64)
    for k in range(BLOCK):
        word, shift = divmod(k * width, 64)
        words[word] |= columns[k] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= columns[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.T).astype(np.uint64)
    out = np.zeros((BLOCK, words.shape[0]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for k in range(BLOCK):
        word, shift = divmod(k * width, 64)
        value = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= columns[word + 1] << np.uint64(64 - shift)
        out[k] = value & mask
    return np.ascontiguousarray(out.T).astype(np.uint32)


class Writer:
    """Writes documents in the order given; holds one batch of blocks and the indexes."""

    def __init__(self, sink):
        self.sink = sink
        sink.write(struct.pack(_HEADER, MAGIC, 1, BLOCK, PERCENTILE))
        self.at = struct.calcsize(_HEADER)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.index: list[np.ndarray] = []
        self.patches: list[np.ndarray] = []
        self.n_patches = self.n_ids = 0
        self.documents: list[tuple[int, int, int]] = []

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.documents.append((key or 0, key is None, len(ids)))
        self.waiting.append(ids.astype(np.uint32))
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= BLOCK * BATCH:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        whole = len(ids) // BLOCK * BLOCK
        for k in range(0, whole, BLOCK * BATCH):
            part = ids[k : min(k + BLOCK * BATCH, whole)]
            self._blocks(part.reshape(-1, BLOCK), BLOCK)
        rest = ids[whole:]
        if last and len(rest):
            padded = np.full((1, BLOCK), rest.min(), np.uint32)
            padded[0, : len(rest)] = rest
            self._blocks(padded, len(rest))
            rest = rest[:0]
        self.waiting, self.n_waiting = [rest], len(rest)

    def _blocks(self, rows: np.ndarray, count: int) -> None:
        low = rows.min(axis=1)
        rows = rows - low[:, None]
        bits = _bits(rows)
        kth = (BLOCK - 1) * PERCENTILE // 100
        width = np.partition(bits, kth, axis=1)[:, kth]
        out = bits > width[:, None]
        block, position = np.nonzero(out)
        patches = np.empty(len(block), PATCH)
        patches["at"], patches["value"] = position, rows[block, position]
        rows[block, position] = 0
        entries = np.zeros(len(rows), INDEX)
        entries["low"], entries["count"], entries["width"] = low, count, width
        entries["patch"] = self.n_patches + np.concatenate([[0], np.cumsum(out.sum(axis=1))[:-1]])
        sizes = width.astype(np.int64) * (BLOCK // 8)
        entries["at"] = self.at + np.concatenate([[0], np.cumsum(sizes)[:-1]])
        packed: list[bytes] = [b""] * len(rows)
        for w in np.unique(width):
            if w:
                which = np.flatnonzero(width == w)
                for i, words in zip(which, _pack(rows[which], int(w))):
                    packed[i] = words.tobytes()
        self.sink.write(b"".join(packed))
        self.at += int(sizes.sum())
        self.index.append(entries)
        self.patches.append(patches)
        self.n_patches += len(patches)

    def finish(self) -> None:
        self._flush(True)
        n_blocks = sum(map(len, self.index))
        for part in (*self.patches, *self.index, np.array(self.documents, DOCUMENT)):
            self.sink.write(part.tobytes())
        self.sink.write(
            struct.pack(_TRAILER, n_blocks, self.n_patches, len(self.documents), self.n_ids, MAGIC)
        )


class Reader:
    """Reads a file that can be seeked; decodes a batch of blocks at a time."""

    def __init__(self, source):
        self.source = source
        source.seek(0, 2)
        end = source.tell()
        source.seek(end - struct.calcsize(_TRAILER))
        blocks, patches, documents, self.n_ids, magic = struct.unpack(_TRAILER, source.read(struct.calcsize(_TRAILER)))
        source.seek(0)
        if magic != MAGIC or struct.unpack(_HEADER, source.read(struct.calcsize(_HEADER)))[:3] != (MAGIC, 1, BLOCK):
            raise ValueError("not a file of packed ids")
        sizes = [patches * PATCH.itemsize, blocks * INDEX.itemsize, documents * DOCUMENT.itemsize]
        source.seek(end - struct.calcsize(_TRAILER) - sum(sizes))
        self.patches = np.frombuffer(source.read(sizes[0]), PATCH)
        self.index = np.frombuffer(source.read(sizes[1]), INDEX)
        self.documents = np.frombuffer(source.read(sizes[2]), DOCUMENT)

    def blocks(self, first: int, last: int) -> np.ndarray:
        """The ids of blocks first to last - 1."""
        entries = self.index[first:last]
        if not len(entries):
            return np.zeros(0, np.uint32)
        widths = entries["width"].astype(np.int64)
        start = int(entries["at"][0])
        self.source.seek(start)
        data = self.source.read(int(entries["at"][-1]) - start + int(widths[-1]) * (BLOCK // 8))
        words = np.frombuffer(data, "<u8")
        rows = np.zeros((len(entries), BLOCK), np.uint32)
        for w in np.unique(widths):
            if w:
                which = np.flatnonzero(widths == w)
                at = (entries["at"][which].astype(np.int64) - start) // 8
                picked = words[at[:, None] + np.arange(BLOCK * w // 64)]
                rows[which] = _unpack(picked, int(w))
        end = int(self.index["patch"][last]) if last < len(self.index) else len(self.patches)
        own = self.patches[int(entries["patch"][0]) : end]
        counts = np.diff(np.append(entries["patch"].astype(np.int64), end))
        rows[np.repeat(np.arange(len(entries)), counts), own["at"]] = own["value"]
        rows += entries["low"][:, None]
        flat = rows.reshape(-1)
        return flat if (entries["count"] == BLOCK).all() else flat[: int(entries["count"].sum())]

    def __iter__(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(key, ids before it in the file, ids) of each document."""
        held, block, start = np.zeros(0, np.uint32), 0, 0
        for key, null, n in self.documents.tolist():
            parts, have = [held], len(held)
            while have < n:
                parts.append(self.blocks(block, min(block + BATCH, len(self.index))))
                block += BATCH
                have += len(parts[-1])
            whole = np.concatenate(parts) if len(parts) > 1 else held
            yield (None if null else key), start, whole[:n]
            held, start = whole[n:], start + n
