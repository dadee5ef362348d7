"""Prefix trie, periodic runs and byte pairs against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from weekloom.llm import bpe, periodic_runs, prefix_trie, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---- prefix trie -----------------------------------------------------------------------------


def plain_trie(convs):
    """Nodes of {conv_id: [(role, text), ...]} by walking every prefix."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    out = {}
    for node, ids in members.items():
        below = [m for m in members if m[:len(node)] == node]
        out[min(ids), len(node)] = (
            min(members[node[:-1]]) if node else None, len(ids), sum(len(m) == len(node) + 1 for m in below),
            sum(not any(len(o) == len(m) + 1 and o[:len(m)] == m for o in members) for m in below),
            sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m), sha(",".join(map(str, sorted(ends[node])))))
    return out


def trie_rows(df):
    cols = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    rows = df.collect()
    got = {(r["conv_id"], r["depth"]): tuple(r[c] for c in cols) for r in rows}
    assert len(got) == len(rows)
    return got


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, vc long, depth string")


def test_trie_of_shared_prefixes_and_long_chains(spark):
    rng = random.Random(4)
    rows, convs = [], {}
    for c in range(60):
        size = rng.choice([1, 2, 3, 5, 40, 90])
        same = rng.randint(0, size)
        turns = [("user" if k % 2 else None, "é" * (k % 5) if k < same else rng.choice(["x", "y", None])) for k in range(size)]
        convs[c] = [(r or "", t or "") for r, t in turns]
        rows += [(c, None if k == 0 else k, r, t, 1, "z") for k, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    assert trie_rows(prefix_trie.trie(conversations(spark, rows))) == plain_trie(convs)


def test_trie_of_copies_ties_and_nulls(spark):
    rows = [(c, 1, "user", "same", 0, "") for c in range(50, 0, -1)] + [(7, 1, "user", "same", 0, ""), (None, 1, "user", "same", 0, "")]
    got = trie_rows(prefix_trie.trie(conversations(spark, rows)))
    assert got == plain_trie({c: [("user", "same")] * (2 if c == 7 else 1) for c in range(1, 51)})
    assert prefix_trie.trie(conversations(spark, rows[:0])).count() == 0
    assert prefix_trie.trie(conversations(spark, rows[-1:])).count() == 0


def test_trie_query_on_rebuilt_conversations(spark, tmp_path):
    rng = random.Random(8)
    rows, own = [], {}
    for c in range(0, 120):
        if c in (5, 20, 33):
            continue
        turns = [(rng.choice("ua"), f"{rng.randint(0, 2)}é") for _ in range(rng.choice([1, 1, 3, 6, 12, 30]))]
        own[c] = turns
        rows += [(c, k, r, t, 0, "") for k, (r, t) in enumerate(turns)]
    conversations(spark, rows).select("conv_id", "turn", "role", "text").write.parquet(f"{tmp_path}/conversations.parquet")
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    assert any(not t for t in built.values())
    assert trie_rows(queries.op11(spark, str(tmp_path))) == plain_trie(built)


# ---- periodic runs ----------------------------------------------------------------------------


def plain_runs(words, least_words=6, least_periods=4):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least_words, least_periods * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_a_plain_search(seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(rng.randint(1, 6)):
        words = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(0, 70))]
        if words and rng.random() < 0.5:
            words += words[-rng.randint(1, 7):] * rng.randint(1, 12)
        docs.append(words)
    least = rng.choice([2, 3, 4])
    got = periodic_runs.runs_of(np.array([w for d in docs for w in d], np.int64), [len(d) for d in docs], 6, least).tolist()
    want, at = [], 0
    for d in docs:
        want += [[s + at, e + at, q] for s, e, q in plain_runs(d, 6, least)]
        at += len(d)
    assert got == want


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    code = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = code // 10, len(words)
    if code % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    best = None
    for s, e, q in runs:
        if best is None or (e - s) * best[2] > best[1] * q:
            best = (s, e - s, q)
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_runs_query(spark, tmp_path):
    rng = random.Random(2)
    texts = {k: " ".join(rng.choice(["a", "b", "\xa0c", "d\x1fe"]) for _ in range(rng.randint(0, 60))) for k in range(300)}
    texts |= {300: None, 301: "", 302: " \n\t", 303: "x " * 9000, 304: "a b " * 5 + "c\x85" + " q" * 7}
    rows = [(k, t, 1) for k, t in texts.items()] + [(None, "z " * 20, 1), (3, texts[3], 1)]
    spark.createDataFrame(rows, "doc_id long, text string, runs int").write.parquet(f"{tmp_path}/documents.parquet")
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k in texts) > 10
    got = sorted(map(tuple, queries.op12(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((plain_row(k, t) for k, t, _ in rows), key=str)


def test_runs_of_an_empty_table(spark):
    assert periodic_runs.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ---- byte pairs -------------------------------------------------------------------------------

TEXTS = ["Hello there, world.", "", None, "a  b   c\n\n d\n e ", "<|endoftext|>x <|startoftext|><|endoftext|>", "İstanbul ΣΑΣ é é ̈x", "a" * 3000,
         "don't WE'LL 's't", "😀 日本語テキスト" * 30, "\x00z\x85a b　c", "ab" * 500 + " " + "=-" * 300, "x́̂ ́y", "<|endoftext|", "<|EndOfText|>",
         "word " * 5000, "﻿x​y", "ﬁ Å İ̇"]


def some_texts():
    rng = random.Random(6)
    letters = "abcdeABC ''é日\n\t<|>endoftx01-=+́😀Σİß　"
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(600)]
    wide = ["".join(chr(rng.choice([rng.randrange(0x20, 0x3000), rng.randrange(0xA000, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(40))
            for _ in range(400)]
    return [*(t or "" for t in TEXTS), *mixed, *wide]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_and_texts_equal_the_library(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    own, library = bpe.Bpe(path), Tokenizer.from_file(path)
    for text, ids in zip(some_texts(), own.encode(some_texts())):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert own.decode(want) == library.decode(want, skip_special_tokens=False)


def test_merges_that_make_a_lower_rank_go_one_at_a_time(tmp_path):
    import json

    from tokenizers import Tokenizer

    tokens = ["a", "b", "c", "ab", "bc", "abc", "aba", "abab"]
    merges = [["b", "c"], ["ab", "a"], ["a", "b"], ["ab", "c"], ["ab", "ab"]]
    path = tmp_path / "small.json"
    path.write_text(json.dumps({"version": "1.0", "added_tokens": [], "normalizer": None, "pre_tokenizer": None, "post_processor": None, "decoder": None,
                                "model": {"type": "BPE", "vocab": {t: i for i, t in enumerate(tokens)}, "merges": merges}}))
    own, library = bpe.Bpe(str(path)), Tokenizer.from_file(str(path))
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 30)))
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text).ids, text
    assert own.one_at_a_time.any()


def test_bpe_query(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(k if k != 4 else None, t, "x") for k, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for k, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((k, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, queries.op13(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0
