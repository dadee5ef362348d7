"""Byte-pair encoding in batched numpy merge rounds, and decoding.

All distinct pieces (words, after the tokenizer file's own normalization and
splitting) of a batch lie in one flat array of symbols. Every neighbouring pair
is looked up by binary search among the sorted keys of all merges. In a round
each piece merges its pair of lowest rank at every place, from the left, and
only the pairs beside a merge are looked up again; pieces without a pair leave
the array. A merge that could make a pair of lower rank than its own is done at
one place per round, so that the order is that of one merge at a time.

Texts are cut at spaces where the vocabulary drops them, and a worker keeps the
ids of the distinct parts it has seen, up to a bound that does not change them.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weekloom.llm.common import batches, keyed_texts

# Distinct parts of texts a worker keeps in each of two generations, and pieces merged at a time.
CACHE_PARTS, MERGE_PIECES = 400_000, 50_000
# Characters of the texts that are cut before their new parts are encoded.
BATCH_CHARS = 2 << 20
# Parts that may hold a special token or white space are cut on their own.
APART = re.compile(r"[\s<]")
NONE = np.iinfo(np.int32).max
_LOADED: dict[str, "Bpe"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def loaded(path: str) -> "Bpe":
    """One vocabulary per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Bpe:
    """A tokenizer file with BPE merges: encoding and decoding of texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        model = parts["model"]
        if model["type"] != "BPE":
            raise ValueError(f"not a BPE vocabulary: {path}")
        # The file's own text steps; merges and decoding are done here.
        library = Tokenizer.from_file(path)
        self._normalizer, self._splitter = library.normalizer, library.pre_tokenizer
        self.vocabulary: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in parts["added_tokens"]}
        self._added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.tokens = [""] * (1 + max([*self.vocabulary.values(), *self.added.values()]))
        for token, i in [*self.vocabulary.items(), *self.added.items()]:
            self.tokens[i] = token
        self.joins_bytes = (parts.get("decoder") or {}).get("type") == "ByteLevel"
        self.drops_space = self._pieces(" a") == self._pieces("a") and all(APART.search(t) for t in self.added)
        self._read_merges(model["merges"])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _read_merges(self, merges: Sequence) -> None:
        v = self.vocabulary
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        left, right = (np.array([v[p[i]] for p in pairs], np.int64) for i in (0, 1))
        # A later token has the suffix of its right half alone.
        self.merged = np.array([v[a + b] for a, b in pairs], np.int32)
        self.base = len(self.tokens) + 1
        keys = left * self.base + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        rank = np.arange(len(keys))
        lowest = np.full(self.base, NONE)  # of any pair that holds a token
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        self.one_at_a_time = lowest[self.merged] < rank

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, pieces: Sequence[str]) -> list[bytes]:
        """Ids of each piece of letters; all pieces are merged together, round by round."""
        v, suffix = self.vocabulary, self.suffix
        out = [b""] * len(pieces)
        full = [k for k, p in enumerate(pieces) if p]
        letters = [len(pieces[k]) for k in full]
        flat: list[int] = []
        for k in full:
            flat += map(v.__getitem__, pieces[k][:-1])
            flat.append(v[pieces[k][-1] + suffix])
        symbol, owner = np.array(flat, np.int32), np.repeat(np.array(full, np.int64), letters)
        rank = np.full(len(symbol), NONE, np.int32)  # of a symbol and the next one
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self._rank(symbol[inner], symbol[inner + 1])
        while len(symbol):
            head = np.ones(len(symbol), bool)
            head[1:] = owner[1:] != owner[:-1]
            starts = np.flatnonzero(head)
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbol)))
            done = least == NONE
            if done.any():
                stay = np.repeat(~done, sizes)
                ids, to = symbol[~stay].astype("<u4").tobytes(), 4 * np.cumsum(sizes[done])
                for k, a, z in zip(owner[starts[done]].tolist(), (to - 4 * sizes[done]).tolist(), to.tolist()):
                    out[k] = ids[a:z]
                symbol, owner, rank = symbol[stay], owner[stay], rank[stay]
                least, sizes = least[~done], sizes[~done]
                if not len(symbol):
                    break
            hit = rank == np.repeat(least, sizes)
            at = np.flatnonzero(hit)
            # Of neighbouring places, as in "aaa", every second one from the left.
            fresh = np.ones(len(at), bool)
            fresh[1:] = at[1:] != at[:-1] + 1
            place = np.arange(len(at))
            at = at[(place - place[fresh][np.cumsum(fresh) - 1]) % 2 == 0]
            single = self.one_at_a_time[rank[at]]
            if single.any():
                first = np.ones(len(at), bool)
                first[1:] = owner[at[1:]] != owner[at[:-1]]
                at = at[first | ~single]
            symbol[at] = self.merged[rank[at]]
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            moved = np.cumsum(stay) - 1
            at = moved[at]
            symbol, owner, rank = symbol[stay], owner[stay], rank[stay]
            near = np.zeros(len(symbol), bool)
            near[at] = near[np.maximum(at - 1, 0)] = True
            beside = np.flatnonzero(near)
            ends = (beside + 1 >= len(symbol)) | (owner[np.minimum(beside + 1, len(symbol) - 1)] != owner[beside])
            rank[beside[ends]] = NONE
            beside = beside[~ends]
            rank[beside] = self._rank(symbol[beside], symbol[beside + 1])
        return out

    def _pieces(self, part: str) -> list[str | int]:
        """Pieces to merge, and the ids of special tokens that stand in the text."""
        found: list[str | int] = []
        for k, text in enumerate(self._added.split(part) if self._added else [part]):
            if k % 2:
                found.append(self.added[text])
            elif text:
                if self._normalizer:
                    text = self._normalizer.normalize_str(text)
                found += [p for p, _ in self._splitter.pre_tokenize_str(text)] if self._splitter else [text]
        return found

    def _learn(self, parts: set[str]) -> None:
        if len(self.young) > CACHE_PARTS:
            self.old, self.young = self.young, {}
        missing = []
        for p in parts:
            if p not in self.young:
                if p in self.old:
                    self.young[p] = self.old[p]
                else:
                    missing.append(p)
        for k in range(0, len(missing), MERGE_PIECES):
            some = missing[k:k + MERGE_PIECES]
            cut = self._cut(some)
            distinct = list({p for c in cut for p in c if isinstance(p, str)})
            ids = dict(zip(distinct, self.merge(distinct)))
            self.young.update((p, b"".join([ids[x] if isinstance(x, str) else x.to_bytes(4, "little") for x in c])) for p, c in zip(some, cut))

    def _cut(self, parts: Sequence[str]) -> list[list[str | int]]:
        """Pieces of each part; parts without white space or special tokens go through the text steps together."""
        plain = [p for p in parts if self.drops_space and not APART.search(p)]
        text = " ".join(plain)
        if self._normalizer:
            text = self._normalizer.normalize_str(text)
        lengths = np.array([len(p) for p in text.split(" ")], np.int64)
        if not plain or len(lengths) != len(plain):
            return [self._pieces(p) for p in parts]
        found = self._splitter.pre_tokenize_str(text)
        owner = np.searchsorted(np.cumsum(lengths + 1), [at for _, (at, _) in found], side="right")
        cut: dict[str, list[str | int]] = {p: [] for p in plain}
        lists = list(cut.values())
        for k, (piece, _) in zip(owner.tolist(), found):
            lists[k].append(piece)
        return [cut[p] if p in cut else self._pieces(p) for p in parts]

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        out: list[bytes] = []
        cut: list[list[str]] = []
        held = 0
        for k, text in enumerate(texts):
            cut.append(text.replace("\n", " ").split(" ") if self.drops_space else [text])
            held += len(text)
            if held >= BATCH_CHARS or k == len(texts) - 1:
                self._learn(set().union(*cut))
                out += [b"".join(map(self.young.__getitem__, c)) for c in cut]
                cut, held = [], 0
        return out

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids, special tokens included."""
        tokens = map(self.tokens.__getitem__, ids)
        if not self.joins_bytes:
            return " ".join(tokens)
        letters = byte_letters()
        out = bytearray()
        for t in tokens:
            # A token with a letter that stands for no byte, as a special one may have, is written as it is.
            out += bytes(map(letters.__getitem__, t)) if all(c in letters for c in t) else t.encode()
        return out.decode("utf-8", errors="replace")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit), ids_text (decimal, one space between).

    Special tokens that a text holds literally become their ids; nothing is
    added at either end. Null or empty text: no ids, empty ``ids_text``. A null
    id stays null and repeated rows or ids give a row each. Very long texts are
    encoded whole: a piece of n letters takes n symbols and at most n rounds.
    An empty table gives an empty table. Other columns are not read.
    """
    path = path or default_path()
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("ids_text", pa.string())])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        decimal = list(map(str, range(len(bpe.tokens))))
        for batch in found:
            def rows():
                for doc_id, ids in zip(batch.column(0).to_pylist(), bpe.encode(batch.column(1).to_pylist())):
                    text = " ".join(map(decimal.__getitem__, np.frombuffer(ids, "<u4").tolist()))
                    yield doc_id, len(ids) // 4, ids, text
            yield from batches(rows(), schema, weigh=lambda r: len(r[2]) + len(r[3]))

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary, ids_text string")


def decode(encoded: DataFrame, path: str | None = None, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of the table but ``ids_col``, and the text of its ids as ``out`` (a column of that name is replaced).

    Null ids give a null text, empty ids an empty one; an empty table stays
    empty. Ids outside the vocabulary raise.
    """
    path = path or default_path()
    kept = [c for c in encoded.columns if c not in (ids_col, out)]
    source = encoded.select(*kept, ids_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in found:
            texts = [None if b is None else bpe.decode(np.frombuffer(b, "<u4").tolist()) for b in batch.column(len(kept)).to_pylist()]
            columns = [*(batch.column(k) for k in range(len(kept))), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, out])

    return source.mapInArrow(run, ", ".join(filter(None, [fields, f"`{out}` string"])))
