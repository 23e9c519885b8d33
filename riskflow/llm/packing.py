"""Documents packed into token sequences of one capacity, by minimum bin slack.

Each task takes its documents in blocks. Whole windows of a document longer than the capacity fill
sequences of their own; what remains of each document is one length below the capacity, and a block
is a histogram of such lengths. For each sequence a subset-sum over bitsets finds the multiset of
remaining lengths that comes closest to the capacity; it is used as often as the counts allow.
Where no multiset fills a sequence, a piece cut from another length does, so the only short
sequences are the powers of two that the last ids of a block are laid into.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import slices
from riskflow.llm.tokens import encoder

BLOCK_TOKENS = 8_000_000
BLOCKS_PER_TASK = 1 << 20
SEQUENCES_PER_BLOCK = 1 << 23
PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long")


def closest_fill(counts: Counter[int], target: int) -> Counter[int]:
    """The multiset of the counted lengths whose sum is closest to ``target`` from below.

    Bit s of the set is on if some multiset of the lengths met so far sums to s. The sets before
    each length are kept; going back through them gives how often each length is used.
    """
    full = (1 << (target + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if 0 < x <= target), reverse=True):
        steps.append((length, reach))
        left, shift = min(counts[length], target // length), 1
        while left > 0:  # 1, 2, 4 ... copies at a time, and the rest
            copies = min(shift, left)
            reach |= (reach << (copies * length)) & full
            left, shift = left - copies, shift * 2
        if reach >> target:
            break
    total, used = reach.bit_length() - 1, Counter()
    for length, before in reversed(steps):
        while not before >> total & 1:
            used[length] += 1
            total -= length
    return used


def pack_block(lengths: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that hold every id once.

    Sequences are numbered from 0 and full, but for at most log2(capacity) at the end whose
    lengths are distinct powers of two.
    """
    sequence = 0
    held: dict[int, list[tuple[int, int]]] = {}  # remaining length: (document, start) of each
    for doc, length in enumerate(lengths.tolist()):
        whole = length - length % capacity
        for start in range(0, whole, capacity):
            yield doc, start, capacity, sequence, 0
            sequence += 1
        if length > whole:
            held.setdefault(length - whole, []).append((doc, whole))
    counts = Counter({k: len(v) for k, v in held.items()})
    total = sum(k * n for k, n in counts.items())

    def take(length: int) -> tuple[int, int]:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return held[length].pop()

    while total >= capacity:
        largest = max(counts)
        counts[largest] -= 1  # the window is built around the largest remaining length
        window = closest_fill(counts, capacity - largest)
        counts[largest] += 1
        window[largest] += 1
        slack = capacity - sum(k * n for k, n in window.items())
        times = 1 if slack else min(counts[k] // n for k, n in window.items())
        for _ in range(times):
            offset = 0
            for length, n in window.items():
                for _ in range(n):
                    doc, start = take(length)
                    yield doc, start, length, sequence, offset
                    offset += length
            if slack:  # every length left is longer than the slack, else it would be in the window
                length = max(counts)
                doc, start = take(length)
                yield doc, start, slack, sequence, offset
                held.setdefault(length - slack, []).append((doc, start + slack))
                counts[length - slack] += 1
            sequence += 1
            total -= capacity
    yield from _powers([(k, *at) for k in sorted(counts, reverse=True) for at in held[k]], sequence)


def _powers(items: list[tuple[int, int, int]], sequence: int):
    """The last items laid into sequences as long as the powers of two that make up their sum."""
    room = [1 << b for b in reversed(range(sum(x[0] for x in items).bit_length()))
            if sum(x[0] for x in items) >> b & 1]
    at, offset = 0, 0
    for length, doc, start in items:
        while length:
            part = min(length, room[at] - offset)
            yield doc, start, part, sequence + at, offset
            start, length, offset = start + part, length - part, offset + part
            if offset == room[at]:
                at, offset = at + 1, 0


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, *, capacity: int = 4096, id_col: str = "doc_id",
    text_col: str = "text", with_ids: bool = True, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset, ids_crc32.

    ids holds the piece's ids as little-endian unsigned 32-bit integers (null without
    ``with_ids``). A null text counts as empty and gives its end id alone; a null id is kept;
    repeated rows are documents of their own; an empty table gives no piece; other columns are not
    read. No shuffle: a task packs its own rows in blocks of about ``block_tokens`` ids.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        base = TaskContext.get().partitionId() * BLOCKS_PER_TASK
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size, block = 0, 0
        for batch in slices(batches, "text"):
            ids, offsets = words.encode(batch.column("text"))
            ids = np.insert(ids, offsets[1:], words.dtype.type(end_id))
            held.append((batch.column("doc_id"), ids, np.diff(offsets) + 1))
            size += len(ids)
            if size >= block_tokens:
                yield from block_rows(held, base + block)
                held, size, block = [], 0, block + 1
        if held:
            yield from block_rows(held, base + block)

    def block_rows(held, block: int) -> Iterator[pa.RecordBatch]:
        doc_ids = pa.concat_arrays([h[0] for h in held])
        ids = np.concatenate([h[1] for h in held])
        lengths = np.concatenate([h[2] for h in held])
        first = np.cumsum(lengths) - lengths
        pieces = np.array(list(pack_block(lengths, capacity)), dtype=np.int64).reshape(-1, 5)
        for at in range(0, len(pieces), 1000):
            doc, start, length, sequence, offset = pieces[at:at + 1000].T
            begin = first[doc] + start
            raw = [ids[a:a + n].astype("<u4").tobytes()
                   for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                doc_ids.take(pa.array(doc)), pa.array(start), pa.array(length),
                pa.array(raw if with_ids else [None] * len(raw), pa.binary()),
                pa.array(lengths[doc]), pa.array(sequence + block * SEQUENCES_PER_BLOCK),
                pa.array(offset), pa.array([zlib.crc32(r) for r in raw], pa.int64()),
            ], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset",
                      "ids_crc32"])

    return source.mapInArrow(run, PIECES + ", ids_crc32 long")
