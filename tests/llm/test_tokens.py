"""Packing and binary output against plain encoding."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tokenizers

from weekloom.llm import binary_out, packing, tokens
from weekloom.llm.tokens import Encoder, default_path

TEXTS = ["Hello there, world.", "", None, "a  b   c\n\n d\n e ", " \n x", "\nstart", "tab\tand hard space", "İstanbul ΣΑΣ naïve é",
         "hello <|endoftext|> world", "<|startoftext|><|endoftext|>", "word " * 3000, "1,234.50 don't we'll", "\x00zero", "😀 emoji😀", "trailing \n", "x\r\ny"]


def plain(name, text, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path(name))
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k if k != 5 else None, t, "extra", k) for k, t in enumerate(TEXTS)] + [(3, "same id", "x", 1), (0, TEXTS[0], "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, start int")


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_cut_texts_encode_like_whole_texts(name):
    enc = Encoder(default_path(name))
    texts = [t or "" for t in TEXTS] * 2
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == [plain(name, t, 0)[:-1] for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_letter_runs_with_punctuation_encode_like_whole_texts(name, monkeypatch):
    rng = np.random.default_rng(7)
    letters = list("abcdeSTxyzÉéÀÿßıİŉǅȺɏñØ×÷əΣж漢ªºʼé̈")
    marks = ["", "", "", ".", ",", "'s", "'", "!?", "_", "(", "-b", "0", "…", "<|", "~~", "\u00a0", "\x1c", "ﬁ", "'LL", "’"]
    texts = []
    for _ in range(300):
        words = ["".join(rng.choice(letters, rng.integers(0, 9))) + rng.choice(marks) for _ in range(rng.integers(0, 30))]
        texts.append("".join(w + rng.choice([" ", " ", " ", "\n"]) for w in words))
    monkeypatch.setattr(tokens, "CACHE_SEGMENTS", 60)
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 500)
    enc = Encoder(default_path(name))
    assert enc.splits
    library = tokenizers.Tokenizer.from_file(default_path(name))
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)] == wanted
    assert len(enc.old) > 60


def test_segments_go_with_the_task(spark, docs, tmp_path):
    """A worker that has packed or written holds no segments in its next task."""
    packing.pack(docs).collect()
    binary_out.write_tokens(docs, str(tmp_path))

    def held(parts):
        for part in parts:
            found = [len(e.young) + len(e.old) for e in tokens._ENCODERS.values()]
            yield pa.RecordBatch.from_arrays([pa.array([len(found)] * part.num_rows), pa.array([sum(found)] * part.num_rows)], ["encoders", "segments"])

    seen = spark.range(0, 400, 1, 4).mapInArrow(held, "encoders long, segments long").distinct().collect()
    assert max(r["encoders"] for r in seen) > 0 and {r["segments"] for r in seen} == {0}


def test_special_tokens_as_text():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    text = "hello <|endoftext|> world"
    got = np.frombuffer(Encoder(default_path("byte_bpe_50k.json"), special_as_text=True).encode([text])[0], "<u4").tolist()
    assert got == t.encode(text, add_special_tokens=False).ids and len(got) > 5


def test_best_fill_matches_exhaustive_search():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = rng.integers(1, 40, rng.integers(1, 9)).tolist()
        target = int(rng.integers(1, 90))
        counts = {x: lengths.count(x) for x in lengths}
        sums = {0}
        for x in lengths:
            sums |= {s + x for s in sums}
        got = packing.best_fill(counts, target)
        assert sum(k * v for k, v in got.items()) == max(s for s in sums if s <= target)
        assert all(v <= counts[k] for k, v in got.items())


def test_pack_holds_every_id_once(spark, docs):
    got = packing.pack(docs.coalesce(1)).collect()
    used = defaultdict(list)
    for r in got:
        assert len(r["ids"]) == 4 * r["length"] > 0
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in used.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == 1024 or at & (at - 1) == 0 and at < 1024
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, plain("byte_bpe_50k.json", r["text"], 0)) for r in docs.collect())
    pieces = defaultdict(list)
    for r in got:
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    once = [w for w in want if sum(w[:2] == v[:2] for v in want) == 1]
    for null, doc_id, ids in once:
        parts = sorted(pieces[None if null else doc_id, len(ids)])
        assert sum((p for _, p in parts), []) == ids
        assert [s for s, _ in parts] == np.cumsum([0, *[len(p) for _, p in parts]])[:-1].tolist()
    assert sum(r["length"] for r in got) == sum(len(w[2]) for w in want)


def test_pack_empty_table(spark, docs):
    assert packing.pack(docs.limit(0)).count() == 0


def test_shards_round_trip(spark, docs, tmp_path):
    folder = binary_out.write_tokens(docs, str(tmp_path))
    got = binary_out.read_tokens(spark, folder).orderBy("start").collect()
    want = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, plain("word_bpe_49k.json", r["text"], 2)) for r in docs.collect()), key=lambda w: w[:2])
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got] == [w[:2] for w in want]
    at = 0
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        at += len(ids)
    assert sorted(tuple(np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == sorted(tuple(w[2]) for w in want)


def test_shards_random_access_and_wrong_dictionary(spark, docs, tmp_path):
    folder = binary_out.write_tokens(docs, str(tmp_path))
    few = binary_out.read_tokens(spark, folder, only=[4, 11, 999]).collect()
    assert sorted(r["doc_id"] for r in few) == [4, 11]
    every = {r["doc_id"]: r["start"] for r in binary_out.read_tokens(spark, folder).collect()}
    assert all(r["start"] == every[r["doc_id"]] for r in few)
    name = next(p.name for p in tmp_path.glob("tokens-*/shard-*.tok"))
    (next(tmp_path.glob("tokens-*")) / "dictionary.zdict").write_bytes(b"other")
    with pytest.raises(Exception):
        binary_out.Shard(folder, name)


def test_shards_with_a_trained_dictionary(spark, tmp_path):
    rows = [(k, " ".join(f"word{(k * j) % 97} again" for j in range(60))) for k in range(300)]
    folder = binary_out.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    assert next(tmp_path.glob("tokens-*/dictionary.zdict")).stat().st_size > 0
    got = binary_out.read_tokens(spark, folder).collect()
    assert {r["doc_id"]: crc(np.frombuffer(r["ids"], "<u4")) for r in got} == {k: crc(plain("word_bpe_49k.json", t, 2)) for k, t in rows}


@pytest.mark.parametrize("most", [1, 700, 4 << 20])
def test_a_shard_read_in_turn_equals_its_single_documents(spark, tmp_path, monkeypatch, most):
    rows = [(k, " ".join(f"word{(k * j) % 89} again" for j in range(k % 40))) for k in range(200)]
    folder = binary_out.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path))
    monkeypatch.setattr(binary_out, "READ_BYTES", most)
    for name in sorted(p.name for p in tmp_path.glob("tokens-*/shard-*.tok")):
        with binary_out.Shard(folder, name) as shard:
            assert list(shard.all_rows()) == list(shard.rows(range(len(shard.index))))


def test_shards_follow_the_bytes_of_the_texts(spark, tmp_path, monkeypatch):
    """Not the settings of the shuffle: each task learns its words anew."""
    rows = [(k, " ".join(f"word{(k * j) % 89} again" for j in range(k % 40))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    library = tokenizers.Tokenizer.from_file(default_path("word_bpe_49k.json"))
    wanted = {k: crc([*library.encode(t, add_special_tokens=False).ids, 2]) for k, t in rows}
    small = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in small}
    found = {}
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        for most in (64 << 20, 20_000):
            monkeypatch.setattr(binary_out, "TASK_BYTES", most, raising=False)
            folder = binary_out.write_tokens(docs, str(tmp_path))
            found[most] = spark.read.parquet(f"{folder}/manifest").count()
            got = binary_out.read_tokens(spark, folder).collect()
            assert {r["doc_id"]: crc(np.frombuffer(r["ids"], "<u4")) for r in got} == wanted
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    n_bytes = sum(len(t) for _, t in rows)
    few, many = found.values()
    assert few == 1 and 3 <= many <= -(-n_bytes // 20_000)


def test_shares_of_a_task():
    most, least = binary_out.TASK_BYTES, binary_out.LEAST_BYTES
    assert [binary_out._tasks(n, 6) for n in (0, 1, least + 1, 100 * least, 100 * most)] == [1, 1, 2, max(6, -(-100 * least // most)), 100]


def test_shards_of_an_empty_table(spark, docs, tmp_path):
    assert binary_out.read_tokens(spark, binary_out.write_tokens(docs.limit(0), str(tmp_path))).count() == 0
