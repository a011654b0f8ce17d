"""Pack documents into sequences along a space-filling curve.

Documents become bags of token ids, projected by hashed signs to a few dimensions; the
cell of the projection has a place on a Hilbert curve.  A range exchange sorts
documents by that place, so documents that are alike lie next to each other, and each
range is packed in order.  A document is cut where a sequence is full, so only the
last sequence of a range is not full, and that remainder is laid out in sequences of
power-of-two lengths, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lanewatch.llm.common import text_of, written
from lanewatch.llm.tokens import tokenizer

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
         " sequence_id long, offset long")


def projection(vocabulary: int, dimensions: int, seed: int) -> np.ndarray:
    """Hashed signs per token id and dimension."""
    return np.random.default_rng(seed).choice(
        np.array([-1, 1], np.int8), (vocabulary, dimensions)).astype(np.float32)


def cells(ids: np.ndarray, offsets: np.ndarray, signs: np.ndarray, bits: int) -> np.ndarray:
    """Grid cells of documents: their projected bags, scaled to length one, per axis.

    A coordinate of a vector of length one has mean 0 and standard deviation 1 over
    random signs, whatever the document's length; four deviations span the grid.
    """
    n = len(offsets) - 1
    # Ids lie below 65,536, so a document's number stands before each and equal ones follow each other.
    numbered = np.sort(np.repeat(np.arange(n, dtype=np.uint64) << np.uint64(16), np.diff(offsets)) | ids)
    first = np.flatnonzero(np.append(True, numbered[1:] != numbered[:-1])[:len(numbered)])
    times = np.diff(np.append(first, len(numbered)))
    found, owner = numbered[first], (numbered[first] >> np.uint64(16)).astype(np.int64)
    weighed = signs[(found & np.uint64(0xFFFF)).astype(np.int64)]
    points = np.stack([np.bincount(owner, times * axis, n) for axis in weighed.T], 1)
    points /= np.sqrt(np.maximum(1, np.bincount(owner, times * times, n)))[:, None]
    side = 1 << bits
    return np.clip(np.floor((points + 4) / 8 * side), 0, side - 1).astype(np.int64)


def hilbert_keys(cells_: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell on the Hilbert curve of ``2 ** bits`` cells a side.

    The transposition method that Skilling published in 2004: undo the curve's
    reflections and exchanges bit by bit from the top, then read the Gray code.
    """
    x = [axis.copy() for axis in cells_.T]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, low = 1 << level, (1 << level) - 1
        for i in range(n):
            flip = (x[i] & q) > 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where((x[-1] & (1 << level)) > 0, turn ^ ((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> level) & 1)
    return key


def _encoder(path: str, end_id: int, dimensions: int, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(path)
        signs = projection(1 << 16, dimensions, seed)
        end = np.array([end_id], np.uint16).tobytes()

        def out(docs: list, encoded: list[bytes]) -> pa.RecordBatch:
            offsets = np.cumsum([0] + [len(e) // 2 for e in encoded])
            ids = np.frombuffer(b"".join(encoded), np.uint16)
            keys = hilbert_keys(cells(ids, offsets, signs, bits), bits)
            return pa.RecordBatch.from_pydict({
                "_id": pa.array(docs, pa.int64()), "_key": pa.array(keys),
                "_ids": pa.array(encoded, pa.binary())})

        for batch in batches:
            docs, encoded, size = [], [], 0
            for doc, text in zip(batch.column("_id").to_pylist(), batch.column("_text")):
                docs.append(doc)
                encoded.append(words.encode(text.as_py()) + end)
                size += len(encoded[-1])
                if size > 1 << 20:
                    yield out(docs, encoded)
                    docs, encoded, size = [], [], 0
            if docs:
                yield out(docs, encoded)
    return run


def powers_of_two(n: int) -> list[int]:
    """Powers of two, largest first, that add up to n."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def _packer(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # Ranges have different numbers, so sequence numbers differ across tasks.
        sequence = TaskContext.get().partitionId() << 36
        held: list[tuple] = []  # (doc, start, ids, doc_tokens) not yet laid out
        waiting = 0

        def lay(size: int) -> list[tuple]:
            nonlocal sequence, waiting
            pieces, at = [], 0
            while at < size:
                doc, start, ids, total = held[0]
                took = min(len(ids), size - at)
                pieces.append((
                    doc, start, took, zlib.crc32(ids[:took].astype("<u4").tobytes()), total,
                    sequence, at))
                at += took
                if took == len(ids):
                    held.pop(0)
                else:
                    held[0] = (doc, start + took, ids[took:], total)
            sequence += 1
            waiting -= size
            return pieces

        def out(pieces: list[tuple]) -> pa.RecordBatch:
            names = [p.split()[0] for p in PIECE.split(",")]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*pieces)], names)

        for batch in batches:
            pieces: list[tuple] = []
            for doc, raw in zip(batch.column("_id").to_pylist(), batch.column("_ids")):
                ids = np.frombuffer(raw.as_buffer(), np.uint16)
                held.append((doc, 0, ids, len(ids)))
                waiting += len(ids)
                while waiting >= length:
                    pieces += lay(length)
            if pieces:
                yield out(pieces)
        rest = [piece for size in powers_of_two(waiting) for piece in lay(size)]
        if rest:
            yield out(rest)
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, length: int = 4096,
                   id_col: str = "doc_id", text_col: str = "text", dimensions: int = 4,
                   bits: int = 10, seed: int = 3, ranges: int | None = None) -> DataFrame:
    """One row per piece of a document in a sequence of at most ``length`` tokens.

    A document is the ids of its whole text (null: empty) and ``end_id``; ids lie
    below 65,536.  ``start`` counts the document's ids before the piece, ``offset`` the
    ids before it in its sequence.  Rows that repeat an id are packed each for
    itself.  The last sequences of a range have power-of-two lengths, at most
    log2(length) of them, so no sequence is padded.  ``ranges`` is the number of
    ranges, by default that of shuffle partitions.  Only the two named columns are
    read, so other columns may have any name.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), text_of(text_col).alias("_text"))
    # Written once: the range exchange samples its input, which would tokenize twice.
    encoded = written(texts.mapInArrow(
        _encoder(tokenizer_path, end_id, dimensions, bits, seed),
        "_id long, _key long, _ids binary"), "encoded")
    order = ["_key", "_id", F.xxhash64("_ids")]
    along = (encoded.repartitionByRange(*order) if ranges is None
             else encoded.repartitionByRange(ranges, *order))
    return along.sortWithinPartitions(*order, "_ids").mapInArrow(_packer(length), PIECE)
