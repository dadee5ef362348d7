"""Stupid-backoff language-model scores of every document from the corpus's own counts.

    S(w | h) = c(hw) / c(h)      if hw is in the count table
             = ALPHA * S(w | h') otherwise, h' without its first word
    S(w)     = max(c(w), 1) / N

Count tables hold n-grams that occur at least MIN_COUNT times in the corpus.

Texts are cut into blocks of about BLOCK_WORDS words. A block explodes into its
distinct n-grams with their counts in the block (so a frequent n-gram is one
entry per block, however often it occurs), which are dealt out by ranges of
their hash. Each range sums its table and joins it to the entries it was sent:
the counts go back to the blocks, where the scores of all positions are summed
per document. N-grams of a block and range travel as one packed row, their hashes
as differences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import keyed_texts, stage

WORD = re.compile(r"[^ \t-\r]+")
ORDER, ALPHA, MIN_COUNT = 2, 0.4, 2
BLOCK_WORDS = 1_000_000
# Words of the corpus for each range of hashes, which bounds the table of one task.
RANGE_WORDS = 2_000_000
CACHE_WORDS = 500_000
GOLD = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                    ("vocabulary", pa.binary()), ("tokens", pa.binary())])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    return x ^ (x >> np.uint64(29))


def press(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, byte by byte of all, compressed."""
    return zstandard.ZstdCompressor(level=3).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def unpress(raw: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return np.ascontiguousarray(flat.reshape(4, -1).T).view("<u4").reshape(-1)


def squeeze(codes: np.ndarray) -> bytes:
    """Ascending codes: the first one, and the steps between them in as few bytes each as the largest needs."""
    steps = np.diff(codes)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return codes[:1].astype("<u8").tobytes() + bytes([width]) + planes.tobytes()


def stretch(raw: bytes) -> np.ndarray:
    width = raw[8]
    planes = np.frombuffer(raw, np.uint8, offset=9).reshape(width, -1)
    steps = np.zeros((planes.shape[1] + 1, 8), np.uint8)
    steps[1:, :width] = planes.T
    steps[0] = np.frombuffer(raw, np.uint8, 8)
    return np.cumsum(steps.view("<u8").reshape(-1), dtype=np.uint64)


def blocks_of(texts: DataFrame) -> DataFrame:
    """Blocks of whole documents: ids, numbers of words, hashes of the distinct words, and the words as places in those."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes: dict[str, int] = {}
        names: list = []
        sizes: list[int] = []
        codes: list[np.ndarray] = []
        held, serial = 0, TaskContext.get().partitionId() << 32

        def close() -> pa.RecordBatch:
            vocabulary, tokens, counts = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
            # Frequent words get low numbers, which take less space.
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            vocabulary, tokens = vocabulary[order], place[tokens]
            return pa.RecordBatch.from_arrays([
                pa.array([serial], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([vocabulary.tobytes()], pa.binary()), pa.array([press(tokens)], pa.binary())], schema=BLOCKS)

        for part in parts:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = WORD.findall(text)
                if len(hashes) > CACHE_WORDS:
                    hashes = {}
                for w in set(words):
                    if w not in hashes:
                        hashes[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
                codes.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
                names.append(doc_id)
                sizes.append(len(words))
                held += len(words)
                if held >= BLOCK_WORDS:
                    yield close()
                    names, sizes, codes, held, serial = [], [], [], 0, serial + 1
        if names:
            yield close()
    return texts.mapInArrow(run, "block long, ids array<long>, sizes array<long>, vocabulary binary, tokens binary")


def grams(vocabulary: bytes, tokens: bytes, sizes: list[int], order: int) -> list[np.ndarray]:
    """For n = 1 … order the hash of the n-gram that ends at each position; 0 where the document has too few words before."""
    word = np.frombuffer(vocabulary, np.uint64)[unpress(tokens)]
    ends = np.cumsum(sizes)
    place = np.arange(len(word)) - np.repeat(ends - np.asarray(sizes), sizes)
    out, last = [mix(word + GOLD)], word
    for n in range(2, order + 1):
        # The n-gram that ends here is the shorter one that ended a word before, and this word.
        before = np.concatenate([np.zeros(1, np.uint64), last[:-1]]) if len(last) else last
        last = mix(before * GOLD + word + np.uint64(n))
        out.append(np.where(place >= n - 1, mix(last + GOLD), np.uint64(0)))
    return out


def distinct(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all orders in ascending order of their hash, and their counts."""
    codes, counts = np.unique(np.concatenate(found), return_counts=True)
    return (codes[1:], counts[1:]) if len(codes) and codes[0] == 0 else (codes, counts)


def cuts(codes: np.ndarray, ranges: int) -> tuple[list[int], list[int]]:
    """The ranges of hashes that ascending hashes fall into, and where each begins (and the last one ends)."""
    width = np.uint64(min((1 << 64) // ranges + 1, (1 << 64) - 1))
    used, first = np.unique(np.minimum(codes // width, np.uint64(ranges - 1)), return_index=True)
    return used.tolist(), [*first.tolist(), len(codes)]


def narrow(counts: np.ndarray) -> bytes:
    """Counts in one byte each, the few from 255 on listed apart with their places, compressed."""
    large = np.flatnonzero(counts >= 255)
    parts = (np.array([len(large)], "<u4"), large.astype("<u4"), counts[large].astype("<u8"), np.minimum(counts, 255).astype(np.uint8))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in parts))


def widen(raw: bytes) -> np.ndarray:
    flat = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(flat, "<u4", 1)[0])
    counts = np.frombuffer(flat, np.uint8, offset=4 + 12 * n).astype(np.int64)
    counts[np.frombuffer(flat, "<u4", n, 4)] = np.frombuffer(flat, "<u8", n, 4 + 4 * n)
    return counts


def explode(blocks: DataFrame, ranges: int, order: int) -> DataFrame:
    """(range, block, codes, counts) of every block's distinct n-grams."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for b in part.to_pylist():
                codes, counts = distinct(grams(b["vocabulary"], b["tokens"], b["sizes"], order))
                used, at = cuts(codes, ranges)
                if used:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(used, pa.int64()), pa.array([b["block"]] * len(used), pa.int64()),
                        pa.array([squeeze(codes[a:z]) for a, z in zip(at, at[1:])], pa.binary()),
                        pa.array([narrow(counts[a:z]) for a, z in zip(at, at[1:])], pa.binary())], ["range", "block", "codes", "counts"])
    return blocks.mapInArrow(run, "range long, block long, codes binary, counts binary")


def look_up(exploded: DataFrame, min_count: int) -> DataFrame:
    """(block, range, counts) with the corpus's count of every n-gram sent, 0 where the table does not hold it."""
    def run(group: pa.Table) -> pa.Table:
        sent = [stretch(c) for c in group.column("codes").to_pylist()]
        codes = np.concatenate(sent)
        counts = np.concatenate([widen(c) for c in group.column("counts").to_pylist()])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        table, total = codes[first], np.add.reduceat(counts, first)
        total = np.where(total >= min_count, total, 0)
        answers = [narrow(total[np.searchsorted(table, s)]) for s in sent]
        return pa.table({"block": group.column("block"), "range": group.column("range"), "counts": pa.array(answers, pa.binary())})
    return exploded.groupBy("range").applyInArrow(run, "block long, range long, counts binary")


def log_scores(found: list[np.ndarray], codes: np.ndarray, counts: np.ndarray, n_words: int, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Natural log of S at every position, and the order that gave it."""
    def count(of: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(codes, of), max(len(codes) - 1, 0))
        return np.where(of > 0, counts[at], 0) if len(codes) else np.zeros(len(of), np.int64)

    each = [count(f) for f in found]
    result = np.log(np.maximum(each[0], 1) / n_words)
    used = np.ones(len(result), np.int64)
    for n in range(1, len(found)):
        # The context is the n-gram one shorter that ended a word before.
        context = np.append(0, each[n - 1][:-1])
        known, possible = (each[n] > 0) & (context > 0), found[n] > 0
        result = np.where(known, np.log(np.maximum(each[n], 1) / np.maximum(context, 1)), np.where(possible, result + np.log(alpha), result))
        used = np.where(known, n + 1, used)
    return result, used


def score(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, min_count: int = MIN_COUNT,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, log_score (natural log of the product of all S), mean_log, n_backed_off, one row per document.

    Counts are those of all documents given, each row once, so copies raise
    them. The first word of a document has no history and is scored by S(w)
    without a penalty. A null or empty text has n_words 0, log_score 0 and a
    null mean. Null and repeated ids stay, each row for itself; an empty table
    gives no rows. Other columns are not read.
    """
    blocks = stage(blocks_of(keyed_texts(docs, id_col, text_col)), "lm-blocks")
    n_words = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    ranges = max(1, -(-n_words // RANGE_WORDS))
    answers = look_up(explode(blocks, ranges, order), min_count)

    def run(block: pa.Table, answer: pa.Table) -> pa.Table:
        ids, sizes, sums, backed = [], [], [], []
        told = dict(zip(answer.column("range").to_pylist(), answer.column("counts").to_pylist()))
        counts = np.concatenate([widen(told[k]) for k in sorted(told)]) if told else np.zeros(0, np.int64)
        for b in block.to_pylist():
            found = grams(b["vocabulary"], b["tokens"], b["sizes"], order)
            each, used = log_scores(found, distinct(found)[0], counts, max(n_words, 1), alpha)
            edge = np.concatenate([[0], np.cumsum(b["sizes"])]).astype(np.int64)
            possible = np.sum([f > 0 for f in found], axis=0)
            down = np.concatenate([[0], np.cumsum(used < possible)])
            for k in range(len(b["ids"])):
                lo, hi = edge[k], edge[k + 1]
                sums.append(float(each[lo:hi].sum()))
                backed.append(int(down[hi] - down[lo]))
            ids += b["ids"]
            sizes += b["sizes"]
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(sizes, pa.int64()), "log_score": pa.array(sums, pa.float64()),
                         "n_backed_off": pa.array(backed, pa.int64())})

    done = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "doc_id long, n_words long, log_score double, n_backed_off long")
    return done.select("doc_id", "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log"), "n_backed_off")
