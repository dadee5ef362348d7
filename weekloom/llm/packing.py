"""Packing of tokenised documents into fixed windows by minimum bin slack.

Full windows are cut off each document; what remains (shorter than a window)
goes into a pool. For the longest remainder of the pool, a bitset subset-sum
program over the pool's histogram of lengths finds the multiset of other
remainders that fills the window closest to its capacity, and the snapshots of
the bitset give back how many of each length were taken. If even the best
multiset leaves slack, one more remainder is cut to close it. Only the last
window of a task can stay short: it is cut into sequences whose lengths are
powers of two, which need no padding.

Each task packs the documents of its own input split while it reads them, with
a bounded pool, so nothing is shuffled, no length class gathers in one place,
and a lost task is repeated with the same result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from weekloom.llm.common import as_batch, keyed_texts
from weekloom.llm.tokens import default_path, encoding

TOKENIZER = "byte_bpe_50k.json"
CAPACITY = 1024
# Remainders a task holds before it packs down to half of them.
POOL = 2048
# Pieces of one batch that leaves a task.
FLUSH = 1000
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                   ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])
Piece = tuple  # (doc_id, start, ids as bytes, doc_tokens)


def best_fill(counts: dict[int, int], target: int) -> dict[int, int]:
    """How many of each length to take so that their sum is at most ``target`` and as close to it as possible.

    Bit s of ``reach`` says that the sum s can be made. A length with count c
    enters as items of 1, 2, 4, … pieces, so log2(c) shifts cover every number
    of it; the bitsets before each item are kept to walk back the choice.
    """
    mask = (1 << (target + 1)) - 1
    reach, goal = 1, 1 << target
    taken: list[tuple[int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left, step = min(counts[length], target // length), 1
        while left > 0 and not reach & goal:
            step = min(step, left)
            taken.append((length, step, reach))
            reach |= (reach << (length * step)) & mask
            left, step = left - step, step * 2
        if reach & goal:
            break
    total = reach.bit_length() - 1
    chosen: dict[int, int] = defaultdict(int)
    for length, step, before in reversed(taken):
        if not before >> total & 1:
            total -= length * step
            chosen[length] += step
    return dict(chosen)


class Packer:
    """The pool of one task and the sequences it has closed."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity = capacity
        self.pool: dict[int, list[Piece]] = defaultdict(list)
        self.size = 0
        self.next_id = first_id
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        total, width = len(ids) // 4, self.capacity * 4
        whole = len(ids) // width
        for k in range(whole):
            self.close([(doc_id, k * self.capacity, ids[k * width:(k + 1) * width], total)])
        if len(ids) > whole * width:
            self.put((doc_id, whole * self.capacity, ids[whole * width:], total))

    def put(self, piece: Piece) -> None:
        self.pool[len(piece[2]) // 4].append(piece)
        self.size += 1

    def take(self, length: int) -> Piece:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
        self.size -= 1
        return piece

    def close(self, pieces: list[Piece]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.rows.append((doc_id, start, len(ids) // 4, ids, total, self.next_id, offset))
            offset += len(ids) // 4
        self.next_id += 1

    def fill(self) -> None:
        """Close one window around the longest remainder."""
        chosen = [self.take(max(self.pool))]
        slack = self.capacity - len(chosen[0][2]) // 4
        for length, n in best_fill({k: len(v) for k, v in self.pool.items() if k <= slack}, slack).items():
            chosen += [self.take(length) for _ in range(n)]
            slack -= length * n
        longer = min((k for k in self.pool if k > slack), default=0) if slack else 0
        if longer:
            doc_id, start, ids, total = self.take(longer)
            chosen.append((doc_id, start, ids[:slack * 4], total))
            self.put((doc_id, start + slack, ids[slack * 4:], total))
            slack = 0
        if slack:
            self.close_short(chosen, self.capacity - slack)
        else:
            self.close(chosen)

    def close_short(self, pieces: list[Piece], used: int) -> None:
        """The last tokens of a task, as sequences of descending powers of two."""
        queue = list(pieces)[::-1]
        for bit in reversed(range(used.bit_length())):
            need, now = used & (1 << bit), []
            while need:
                doc_id, start, ids, total = queue.pop()
                here = min(need, len(ids) // 4)
                now.append((doc_id, start, ids[:here * 4], total))
                if here * 4 < len(ids):
                    queue.append((doc_id, start + here, ids[here * 4:], total))
                need -= here
            if now:
                self.close(now)

    def shrink(self, down_to: int) -> None:
        while self.size > down_to:
            self.fill()


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text", segments: int | None = None) -> DataFrame:
    """One row per piece: its ids (little-endian unsigned 32-bit), where they start in the document, and its place.

    A null or empty text is the end id alone. Ids may be null or repeat: every
    row is packed as a document of its own. An empty table gives no rows.
    Other columns are not read. ``segments`` bounds what a task keeps of the
    segments it has encoded: fewer take less memory and more time.
    """
    path = tokenizer or default_path(TOKENIZER)
    end = end_id.to_bytes(4, "little")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)

        def flush() -> Iterator[pa.RecordBatch]:
            rows, packer.rows = packer.rows, []
            for at in range(0, len(rows), FLUSH):
                yield as_batch(rows[at:at + FLUSH], ARROW)

        with encoding(path, segments=segments) as enc:
            for part in parts:
                names, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                for name, ids in zip(names, enc.each(texts)):
                    packer.add(name, ids + end)
                    if packer.size > POOL:
                        packer.shrink(POOL // 2)
                    if len(packer.rows) >= FLUSH:
                        yield from flush()
        packer.shrink(0)
        yield from flush()

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, SCHEMA)
