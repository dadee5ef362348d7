"""Token ids in binary shards: every document is one zstandard frame made with a shared dictionary.

A folder of shards holds

* ``dictionary.zdict``: the dictionary, trained on the serialized ids of a
  bounded sample of documents (it changes sizes only, never ids);
* ``shard-<n>.tok``: the frames of a range of ids in ascending order, then an
  index (id, number of ids, place of the frame) and a footer with the place of
  the index and the SHA-256 of the dictionary;
* ``manifest``: a small table of the shards with their numbers of documents
  and ids, from which each document's first position follows.

A reader opens a shard by its index, so one document costs one small read; all
documents of a shard are read in turn, in blocks of neighbouring frames.
Shards are written under a name of the attempt and moved into place, so a
repeated task leaves one whole file.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weekloom.llm.common import as_batch, batches, keyed_texts
from weekloom.llm.tokens import default_path, encoder, encoding

TOKENIZER = "word_bpe_49k.json"
# Documents, and bytes of each, that the dictionary is trained on at most.
DICTIONARY_DOCS = 2000
DICTIONARY_PIECE = 4096
DICTIONARY_BYTES = 64 * 1024
LEVEL = 3
# Bytes of texts a task takes: every task learns the words it meets, so many small ones learn the same words again and again.
# Where there are fewer such shares than cores, each core gets one, down to the lower bound.
TASK_BYTES, LEAST_BYTES = 64 << 20, 4 << 20
# Bytes of one read where a whole shard is wanted (a longer frame is read alone).
READ_BYTES = 4 << 20
MAGIC = b"WLTOK001"
FOOTER = "<QQ32sBB6x8s"  # index place, documents, dictionary hash, bytes of an id, null ids, magic
INDEX = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("n_tokens", "<u8"), ("at", "<u8"), ("size", "<u4")])
MANIFEST = pa.schema([("shard", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                      ("first_id", pa.int64()), ("last_id", pa.int64()), ("has_null", pa.bool_())])
ROWS = pa.schema([("doc_id", pa.int64()), ("shard", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    found, path = pafs.FileSystem.from_uri(root)
    return found, path.rstrip("/")


def _train(samples: list[bytes]) -> bytes:
    """The dictionary, or nothing where there is too little to learn from."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _tasks(n_bytes: int, cores: int) -> int:
    """Tasks, and shards at most, for so many bytes of texts."""
    return max(1, -(-n_bytes // TASK_BYTES), min(cores, -(-n_bytes // LEAST_BYTES)))


def _packed(ids: bytes, width: int) -> bytes:
    """Ids as stored: 2 bytes each where the vocabulary allows it."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype("<u2").tobytes()


def _sample(texts: DataFrame, path: str, width: int, n_docs: int) -> list[bytes]:
    """The first ids of a bounded share of the documents, for the dictionary alone."""
    share = max(1, n_docs // DICTIONARY_DOCS)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoding(path) as enc:
            for part in parts:
                ids = enc.encode(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array([_packed(i, width)[:DICTIONARY_PIECE] for i in ids], pa.binary())], ["piece"])

    picked = texts.filter(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0).select("text")
    return [bytes(r["piece"]) for r in picked.mapInArrow(run, "piece binary").limit(2 * DICTIONARY_DOCS).collect()]


def write_tokens(docs: DataFrame, root: str, tokenizer: str | None = None, end_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode and write all documents in ascending order of their ids under ``root``; returns the folder.

    A null or empty text is the end id alone. Null ids come first; repeated ids
    are kept, ordered by a hash of their texts. An empty table gives no shards.
    Other columns are not read. The number of shards follows the bytes of the
    texts; they hold about equally many documents.
    """
    spark = docs.sparkSession
    path = tokenizer or default_path(TOKENIZER)
    enc = encoder(path)
    width = 2 if max(enc.vocab_size, end_id + 1) <= 1 << 16 else 4
    end = end_id.to_bytes(4, "little")
    folder = f"{root.rstrip('/')}/tokens-{uuid.uuid4().hex}"
    store, local = _open(folder)
    store.create_dir(local, recursive=True)
    texts = keyed_texts(docs, id_col, text_col)
    n_docs, n_bytes = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    dictionary = _train(_sample(texts, path, width, n_docs))
    with store.open_output_stream(f"{local}/dictionary.zdict") as out:
        out.write(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)  # at most DICTIONARY_BYTES

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard, name = task.partitionId(), f"shard-{task.partitionId():07d}.tok"
        known = shared.value
        data = zstandard.ZstdCompressionDict(known) if known else None
        if data:
            data.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=data)
        index: list[tuple] = []
        out, at, target, temp = None, 0, "", ""
        with encoding(path) as enc:
            for part in parts:
                names, cut = part.column(0).to_pylist(), part.column(1).to_pylist()
                if out is None and names:
                    files, base = _open(folder)
                    target, temp = f"{base}/{name}", f"{base}/.{name}-{task.taskAttemptId()}"
                    out = files.open_output_stream(temp)
                for doc_id, ids in zip(names, enc.each(cut)):
                    frame = press.compress(_packed(ids + end, width))
                    out.write(frame)
                    index.append((doc_id or 0, doc_id is None, len(ids) // 4 + 1, at, len(frame)))
                    at += len(frame)
        if out is None:
            return
        rows = np.array(index, INDEX)
        out.write(press.compress(rows.tobytes()))
        out.write(struct.pack(FOOTER, at, len(rows), hashlib.sha256(known).digest(), width, int(rows["is_null"].any()), MAGIC))
        out.close()
        files.move(temp, target)
        named = rows["doc_id"][rows["is_null"] == 0]
        yield as_batch([(shard, name, len(rows), int(rows["n_tokens"].sum()), int(named.min()) if len(named) else None,
                         int(named.max()) if len(named) else None, bool(rows["is_null"].any()))], MANIFEST)

    (texts.withColumn("h", F.xxhash64("text"))
     .repartitionByRange(_tasks(n_bytes, spark.sparkContext.defaultParallelism), F.col("doc_id").asc_nulls_first(), "h")
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")
     .select("doc_id", "text")
     .mapInArrow(run, "shard long, file string, n_docs long, n_ids long, first_id long, last_id long, has_null boolean")
     .write.parquet(f"{folder}/manifest"))
    return folder


class Shard:
    """Random access to the documents of one shard."""

    def __init__(self, folder: str, name: str):
        store, local = _open(folder)
        with store.open_input_stream(f"{local}/dictionary.zdict") as f:
            known = f.read()
        self.file = store.open_input_file(f"{local}/{name}")
        size = self.file.size()
        tail = struct.calcsize(FOOTER)
        at, n, digest, self.width, _, magic = struct.unpack(FOOTER, self.file.read_at(tail, size - tail))
        if magic != MAGIC or digest != hashlib.sha256(known).digest():
            raise ValueError(f"{name} was not written with this dictionary")
        self.press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known) if known else None)
        packed = self.file.read_at(size - tail - at, at)
        self.index = np.frombuffer(self.press.decompress(packed), INDEX, n)
        self.base = np.concatenate([[0], np.cumsum(self.index["n_tokens"].astype("<i8"))[:-1]])

    def __enter__(self) -> "Shard":
        return self

    def __exit__(self, *_) -> None:
        self.file.close()

    def ids(self, frame) -> bytes:
        """Ids of a frame as little-endian unsigned 32-bit bytes."""
        raw = self.press.decompress(frame)
        return raw if self.width == 4 else np.frombuffer(raw, "<u2").astype("<u4").tobytes()

    def _row(self, k: int, frame) -> tuple:
        row = self.index[k]
        return (None if row["is_null"] else int(row["doc_id"])), int(self.base[k]), int(row["n_tokens"]), self.ids(frame)

    def rows(self, positions) -> Iterator[tuple]:
        """A few documents, by one read each."""
        for k in positions:
            row = self.index[k]
            yield self._row(k, self.file.read_at(int(row["size"]), int(row["at"])))

    def all_rows(self) -> Iterator[tuple]:
        """Every document in its order, by reads of many neighbouring frames."""
        starts = self.index["at"].astype("<i8")
        ends = starts + self.index["size"]
        first = 0
        while first < len(starts):
            last = max(first + 1, int(np.searchsorted(ends, starts[first] + READ_BYTES, "right")))
            block = memoryview(self.file.read_at(int(ends[last - 1] - starts[first]), int(starts[first])))
            for k in range(first, last):
                yield self._row(k, block[starts[k] - starts[first]:ends[k] - starts[first]])
            first = last


def _shards(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest, with the number of ids in all shards before each."""
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return spark.read.parquet(f"{folder}/manifest").withColumn("before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, folder: str, only: list[int] | None = None) -> DataFrame:
    """Documents read back from the shards: doc_id, shard, start (ids of all documents before it), n_tokens, ids.

    ``only`` names a few ids: just the shards whose range can hold one are
    opened, and just their frames are read.
    """
    wanted = None if only is None else sorted(set(only))
    shards = _shards(spark, folder)
    if wanted is not None:
        listed = F.array(*[F.lit(i).cast("long") for i in wanted])
        shards = shards.filter(F.exists(listed, lambda i: i.between(F.col("first_id"), F.col("last_id"))))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for part in parts:
                for r in part.to_pylist():
                    with Shard(folder, r["file"]) as shard:
                        rows = shard.all_rows() if wanted is None else shard.rows(np.flatnonzero(
                            np.isin(shard.index["doc_id"], wanted) & (shard.index["is_null"] == 0)))
                        for doc_id, start, n, ids in rows:
                            yield doc_id, r["shard"], r["before"] + start, n, ids
        yield from batches(found(), ROWS, weigh=lambda row: len(row[4]))

    # One shard a task: the manifest's rows are dealt out evenly by their number.
    spread = spark.read.parquet(f"{folder}/manifest").select("shard").count()
    return (shards.select("shard", "file", "before").repartitionByRange(max(1, spread), "shard")
            .mapInArrow(run, "doc_id long, shard long, start long, n_tokens long, ids binary"))
