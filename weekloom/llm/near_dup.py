"""Near copies by ProbMinHash: sketches of weighted shingles, banding, exact verification.

The weight of a five-word shingle is its count in the text. A sketch has one
register per component; every shingle is a Poisson process whose rate is its
weight and whose points each hit a random register, and a register keeps the
shingle that came first. Points are drawn in rounds, for all shingles of a
batch of texts at once, and a shingle stops as soon as its next point would
come after the latest register of its text. Two texts agree on a register with
the probability Jaccard similarity of their weighted shingles,

    J_P = sum_i 1 / sum_j max(a_j / a_i, b_j / b_i).

Registers are cut into bands. Texts alike in a band are compared:

1. Exact copies (same words) are one representative from the start.
2. Every member of a band group is compared with the group's first member:
   first by sketch, then exactly. The number of comparisons is that of members.
3. Links give components. Groups that still hold several components are
   compared inside: the members outside the largest component against all, in
   blocks, by sketch, and exactly where two texts of different components seem
   alike. Only new links leave a task.

So a large group of copies costs its size, and only mixed groups cost more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from weekloom.llm.common import keyed_texts, prepare, stage

SHINGLE = 5
SIMILARITY = 0.8
# 40 bands of 6 registers: a pair at 0.8 is missed with probability 5e-6.
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
# Sketches of a pair at 0.8 agree on less than this with a probability of 2e-6 (4.6 standard errors).
SKETCH_LEAST = 0.68
# Below so many running processes a step draws several points of each.
FEW_PROCESSES, POINTS = 4096, 16
# Texts sketched at once, characters of them, and distinct words whose hashes a task keeps.
SKETCH_TEXTS, SKETCH_CHARS, KNOWN_WORDS = 100, 1 << 20, 100_000
# Members of a block when a mixed group is compared inside.
BLOCK = 512
# Up to so many ids (8 bytes each) go to all executors to pick their texts; beyond, texts are shuffled to them.
SMALL_IDS = 1_000_000
GOLD, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number of each input."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def shingles(text: str, codes: dict[str, int] | None = None) -> np.ndarray:
    """64-bit codes of the shingles of a text, in order; a text of fewer than five words is one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    codes = {} if codes is None else codes
    for w in set(words):
        if w not in codes:
            codes[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
    word = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
    n = max(1, len(word) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(word))):
        out = mix(out * GOLD + word[k:k + n] + np.uint64(k + 1))
    return out


def weighted(text: str, codes: dict[str, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles in ascending order and their counts."""
    return np.unique(shingles(text, codes), return_counts=True)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two weighted sets.

    With r = a_i / b_i the inner sum is (A(r_j >= r) / a_i) + (B(r_j < r) / b_i),
    so sorting by the ratio gives all of them from running sums.
    """
    both, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    wa, wb = a[1][ia].astype(float), b[1][ib].astype(float)
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    ratio = wa / wb
    order = np.argsort(ratio, kind="stable")
    wa, wb, ratio = wa[order], wb[order], ratio[order]
    below_b = np.concatenate([[0.0], np.cumsum(wb)])
    above_a = wa.sum() - np.concatenate([[0.0], np.cumsum(wa)])
    first = np.searchsorted(ratio, ratio, "left")
    inner = (above_a[first] + only_a) / wa + (below_b[first] + only_b) / wb
    return float((1 / inner).sum())


def sketch_batch(items: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Registers of several texts: one row each; rows of texts without shingles are zero."""
    n = len(items)
    sizes = np.array([len(x[0]) for x in items], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    code = np.concatenate([x[0] for x in items]) if n else np.zeros(0, np.uint64)
    weight = np.concatenate([x[1] for x in items]).astype(float) if n else np.zeros(0)
    least = np.full(n * REGISTERS, np.inf)
    held = np.zeros(n * REGISTERS, np.uint64)
    when = np.zeros(len(code))
    point = 0
    while len(code):
        # The next points of every process still running, and the registers they hit; several where few run.
        # A point after the latest register of its text hits none, so it does no harm.
        many = 1 if len(code) >= FEW_PROCESSES else POINTS
        turns = np.array([int(GOLD) * (2 * (point + k) + 1) % (1 << 64) for k in range(many)], np.uint64)
        seed = mix(code[:, None] + turns)
        unit = ((seed >> np.uint64(11)).astype(float) + 1) / float(1 << 53)
        times = np.cumsum(np.concatenate([when[:, None], -np.log(unit) / weight[:, None]], axis=1), axis=1)[:, 1:]
        place = owner[:, None] * REGISTERS + (mix(seed + GOLD) % np.uint64(REGISTERS)).astype(np.int64)
        hit = times < least[place]
        p, h, c = place[hit], times[hit], np.broadcast_to(code[:, None], hit.shape)[hit]
        when = times[:, -1]
        order = np.argsort(-h, kind="stable")  # the earliest point is written last
        p, h, c = p[order], h[order], c[order]
        least[p] = h
        held[p] = c
        latest = least.reshape(n, REGISTERS).max(1)
        go = when < latest[owner]
        code, weight, owner, when = code[go], weight[go], owner[go], when[go]
        point += many
    return held.reshape(n, REGISTERS)


def blocks(ids: list[int], texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """The texts in turn, as many at once as SKETCH_TEXTS and SKETCH_CHARS allow; a longer one alone."""
    block: list[tuple[int, str]] = []
    held = 0
    for doc_id, text in zip(ids, texts):
        if block and (len(block) >= SKETCH_TEXTS or held + len(text) > SKETCH_CHARS):
            yield block
            block, held = [], 0
        block.append((doc_id, text))
        held += len(text)
    if block:
        yield block


def sketches(texts: DataFrame) -> DataFrame:
    """doc_id, words (a hash of the words), bands (one hash each) and marks (one byte per register) of texts with words."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, int] = {}
        for part in parts:
            for block in blocks(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if len(codes) > KNOWN_WORDS:
                    codes = {}
                sets, names, same = [], [], []
                for doc_id, text in block:
                    found = shingles(text, codes)
                    if len(found):
                        sets.append(np.unique(found, return_counts=True))
                        names.append(doc_id)
                        same.append(xxhash.xxh3_128_digest("\x1f".join(text.lower().split()).encode("utf-8", "surrogatepass")))
                if not names:
                    continue
                held = sketch_batch(sets)
                band = np.zeros((len(names), BANDS), np.uint64)
                grid = held.reshape(len(names), BANDS, ROWS)
                for k in range(ROWS):
                    band = mix(band * GOLD + grid[:, :, k])
                band = mix(band + np.arange(BANDS, dtype=np.uint64))
                marks = (mix(held) & np.uint64(255)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    pa.array(names, pa.int64()), pa.array(same, pa.binary()),
                    pa.array(list(band.view(np.int64)), pa.list_(pa.int64())), pa.array([m.tobytes() for m in marks], pa.binary())],
                    ["doc_id", "words", "bands", "marks"])
    return texts.mapInArrow(run, "doc_id long, words binary, bands array<long>, marks binary")


def pack(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """The codes, then counts in 4 bytes each; no counts where all are 1, as in most texts."""
    return codes.tobytes() + (counts.astype("<u4").tobytes() + b"#" if len(counts) and counts.max() > 1 else b"")


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    if len(raw) % 4:
        n = len(raw) // 12
        return np.frombuffer(raw, np.uint64, n), np.frombuffer(raw, "<u4", n, 8 * n).astype(np.int64)
    codes = np.frombuffer(raw, np.uint64)
    return codes, np.ones(len(codes), np.int64)


def weighted_sets(texts: DataFrame) -> DataFrame:
    """member and its weighted shingles in packed form."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = pa.array([pack(*weighted(t)) for t in part.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), found], ["member", "shingles"])
    return texts.mapInArrow(run, "member long, shingles binary")


def texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of these members."""
    wanted = stage(ids.select(F.col("member").alias("doc_id")).distinct(), "near-wanted")
    return texts.join(F.broadcast(wanted) if wanted.count() <= SMALL_IDS else wanted, "doc_id", "left_semi")


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal marks, less what equal bytes owe to chance."""
    raw = (a == b).mean(-1)
    return (raw - 1 / 256) / (1 - 1 / 256)


def alike(pairs: DataFrame, left: str, right: str, least: float = SKETCH_LEAST) -> DataFrame:
    """Keep pairs whose marks (binary columns) agree well enough."""
    keep = pairs.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(-1, REGISTERS) for c in (left, right))
                yield part.filter(pa.array(agreement(a, b) >= least))
    return pairs.mapInArrow(run, pairs.schema).select(*keep)


class Groups:
    """Union-find inside one task, over names that may already share a component."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (y := self.up.get(x, x)) != x:
            path.append(x)
            x = y
        for p in path:
            self.up[p] = x
        return x

    def join(self, a: int, b: int) -> None:
        self.up[self.root(a)] = self.root(b)


def cross_cells(members: DataFrame) -> DataFrame:
    """Deal every mixed group out as cells in which members of different components meet.

    Only members outside the group's largest component (``moves``) have to meet
    all others; the members of that one are of one class already. Every member
    has a home block; the moving ones are cut into blocks too and go to every
    home, so a group of n members with s moving ones makes about n rows as long
    as s fits into a block, and no more than (n s) / BLOCK twice beyond.
    Marks and shingles are joined afterwards, so that they move once.
    """
    parts = members.groupBy("band", "component").agg(F.count("*").alias("n"))
    largest = stage(parts.groupBy("band").agg(F.max_by("component", F.struct("n", "component")).alias("largest"), F.sum("n").alias("n"),
                                              (F.sum("n") - F.max("n")).alias("s")), "near-largest")
    dealt = members.join(largest, "band").withColumn("moves", F.col("component") != F.col("largest"))
    homes, turns = (F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK)).cast("int") for c in ("n", "s"))
    here = dealt.select("band", "member", "component", "moves", homes.alias("homes"), turns.alias("turns"), F.xxhash64("member").alias("h"))
    home, turn = F.pmod("h", F.col("homes")).cast("int"), F.pmod("h", F.col("turns")).cast("int")
    at_home = here.select("band", "member", "component", home.alias("home"), F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.lit(False).alias("moves"))
    moving = here.filter("moves").select("band", "member", "component", F.explode(F.sequence(F.lit(0), F.col("homes") - 1)).alias("home"),
                                         turn.alias("turn"), F.lit(True).alias("moves"))
    return at_home.unionByName(moving).select(F.xxhash64("band", "home", "turn").alias("cell"), "band", "member", "component", "moves")


def by_cell(cells: DataFrame) -> GroupedData:
    """Cells spread over as many tasks as the session has for shuffles: their work is in comparing, not in their bytes."""
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cells.repartition(tasks, "cell").groupBy("cell")


def seem_alike(cells: DataFrame) -> DataFrame:
    """Of each cell, (band, member) of those that seem alike to a member of another component."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        marks = np.frombuffer(b"".join(group["marks"]), np.uint8).reshape(-1, REGISTERS)
        component, moves, found = group["component"].to_numpy(), group["moves"].to_numpy(), np.zeros(len(group), bool)
        home = np.flatnonzero(~moves)
        at_home, theirs = marks[home], component[home]
        for k in np.flatnonzero(moves).tolist():
            near = (theirs != component[k]) & (agreement(at_home, marks[k]) >= SKETCH_LEAST)
            if near.any():
                found[k] = True
                found[home[near]] = True
        return group.loc[found, ["band", "member"]]
    return by_cell(cells).applyInPandas(run, "band long, member long")


def inner_links(cells: DataFrame) -> DataFrame:
    """Of each cell, verified links between different components, as many as join them."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        marks = np.frombuffer(b"".join(group["marks"]), np.uint8).reshape(-1, REGISTERS)
        component, name, moves = group["component"].tolist(), group["member"].tolist(), group["moves"].to_numpy()
        sets, known, out = group["shingles"].tolist(), {}, []
        joined = Groups()
        home = np.flatnonzero(~moves)
        at_home = marks[home]

        def of(k: int):
            if k not in known:
                known[k] = unpack(sets[k])
            return known[k]

        for k in np.flatnonzero(moves).tolist():
            near = agreement(at_home, marks[k])
            for j in np.argsort(-near, kind="stable"):
                if near[j] < SKETCH_LEAST:
                    break
                o = int(home[j])
                if joined.root(component[k]) != joined.root(component[o]) and probability_jaccard(of(k), of(o)) >= SIMILARITY:
                    joined.join(component[k], component[o])
                    out.append((name[k], name[o]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    return by_cell(cells).applyInPandas(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(member, component) of every member with an edge; the component is its least member.

    Each round takes the least component among the neighbours and then jumps
    to that one's own component, until nothing changes.
    """
    both = stage(edges.select(F.col("a").alias("member"), F.col("b").alias("near"))
                 .unionByName(edges.select(F.col("b").alias("member"), F.col("a").alias("near"))).distinct(), "near-edges")
    now = stage(both.groupBy("member").agg(F.least(F.min("near"), F.min("member")).alias("component")), "near-round")
    while True:
        seen = both.join(now.select(F.col("member").alias("near"), F.col("component").alias("theirs")), "near")
        best = seen.groupBy("member").agg(F.min("theirs").alias("theirs"))
        step = now.join(best, "member").select("member", "component", F.least("component", "theirs").alias("least"))
        jump = now.select(F.col("member").alias("least"), F.col("component").alias("further"))
        new = stage(step.join(jump, "least", "left").select(
            "member", F.least("least", F.coalesce("further", "least")).alias("component"),
            (F.least("least", F.coalesce("further", "least")) != F.col("component")).alias("changed")), "near-round")
        if new.filter("changed").isEmpty():
            return new.select("member", "component")
        now = new.select("member", "component")


def _classes(texts: DataFrame, every: DataFrame) -> DataFrame:
    """Classes of texts with distinct ids from their sketches, and whether a text has no words (``blank``)."""
    # Copies: the least id of those with the same words stands for them.
    first = stage(every.groupBy("words").agg(F.min("doc_id").alias("member")), "near-copies")
    copy_of = stage(every.select("doc_id", "words").join(first, "words").select("doc_id", "member"), "near-copy-of")
    single = every.join(first.select(F.col("member").alias("doc_id")), "doc_id", "left_semi").select(F.col("doc_id").alias("member"), "bands", "marks")
    single = stage(single, "near-single")
    marks = single.select("member", "marks")

    banded = single.select("member", F.explode("bands").alias("band"))
    groups = stage(banded.groupBy("band").agg(F.min("member").alias("first"), F.count("*").alias("n")).filter("n > 1").select("band", "first"), "near-groups")
    members = stage(banded.join(groups, "band"), "near-members")

    pairs = members.filter("member <> first").select("member", "first").distinct()
    pairs = pairs.join(marks, "member").join(marks.select(F.col("member").alias("first"), F.col("marks").alias("first_marks")), "first")
    pairs = stage(alike(pairs, "marks", "first_marks").select("member", "first"), "near-pairs")
    sets = stage(weighted_sets(texts_of(texts, pairs.select("member").union(pairs.select("first")))), "near-sets")
    compared = pairs.join(sets, "member").join(sets.select(F.col("member").alias("first"), F.col("shingles").alias("first_shingles")), "first")

    def verify(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            a, b = (part.column(c).to_pylist() for c in ("shingles", "first_shingles"))
            good = [probability_jaccard(unpack(x), unpack(y)) >= SIMILARITY for x, y in zip(a, b)]
            yield part.select(["member", "first"]).filter(pa.array(good, pa.bool_()))

    links = stage(compared.mapInArrow(verify, "member long, first long").select(F.col("member").alias("a"), F.col("first").alias("b")), "near-links")
    linked = components(links)

    # Groups that still hold more than one component.
    placed = members.select("band", "member").join(linked, "member", "left").withColumn("component", F.coalesce("component", "member"))
    placed = stage(placed, "near-placed")
    mixed = stage(placed.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("band"), "near-mixed")
    inside = cross_cells(placed.join(mixed, "band")).join(marks, "member")
    near = stage(seem_alike(inside).distinct(), "near-inside")
    if not near.isEmpty():
        sets = stage(weighted_sets(texts_of(texts, near)), "near-sets")
        again = cross_cells(near.join(placed, ["band", "member"])).drop("band").join(marks.join(sets, "member"), "member")
        linked = components(links.unionByName(stage(inner_links(again), "near-inner-links")))
    result = (copy_of.join(linked, "member", "left").select("doc_id", F.coalesce("component", "member").alias("class_id"), F.lit(False).alias("blank")))
    blank = texts.select("doc_id").join(copy_of.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(True).alias("blank"))
    return result.unionByName(blank).withColumn("kept", F.col("doc_id") == F.col("class_id"))


def _row_keys(docs: DataFrame, id_col: str, text_col: str) -> Column:
    """Key of a row: its id where all ids differ and none is null, else a hash of id and text."""
    doc_id = F.col(id_col).cast("long")
    n = docs.agg(F.count("*").alias("rows"), F.count_distinct(doc_id).alias("ids")).first()
    return doc_id if n["rows"] == n["ids"] else F.xxhash64(doc_id, F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def row_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (least id of its class) and kept, one row per distinct pair of id and text.

    Classes are the connected parts of "J_P of the five-word shingles is at
    least 0.8"; words are split at white space and compared in lower case. A
    text of fewer than five words is one shingle, one without words (null,
    empty, blank) is its own class. Rows that share an id, and rows with a null
    id, are compared like all others. class_id is null if no row of the class
    has an id; of the rows of a class one with the least id is kept. Very long
    texts are compared whole. An empty table gives no rows. Other columns are
    not read.
    """
    return _row_classes(docs, _row_keys(docs, id_col, text_col), id_col, text_col).select("doc_id", "class_id", "kept")


def _row_classes(docs: DataFrame, key: Column, id_col: str, text_col: str) -> DataFrame:
    """As :func:`row_classes`, with row_key, its number of rows (``n``) and blank."""
    prepare(docs.sparkSession)
    rows = docs.select(key.alias("row_key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = stage(rows.groupBy("row_key").agg(F.first("doc_id").alias("name"), F.count("*").alias("n")), "near-rows")
    texts = rows.select(F.col("row_key").alias("doc_id"), "text")
    if not names.filter("n > 1").isEmpty():
        texts = stage(texts.groupBy("doc_id").agg(F.first("text").alias("text")), "near-texts")
    found = _classes(texts, stage(sketches(texts), "near-sketches"))
    found = stage(found.select(F.col("doc_id").alias("row_key"), F.col("class_id").alias("part"), "blank").join(names, "row_key"), "near-row-parts")
    best = found.groupBy("part").agg(F.min(F.struct(F.col("name").isNull().alias("unnamed"), "name", "row_key")).alias("best"))
    return found.join(best, "part").select("row_key", F.col("name").alias("doc_id"), F.col("best.name").alias("class_id"),
                                           (F.col("row_key") == F.col("best.row_key")).alias("kept"), "blank", "n")


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: one row of every class of :func:`row_classes` stays, and every row without words."""
    key = _row_keys(docs, id_col, text_col)
    found = stage(_row_classes(docs, key, id_col, text_col), "near-row-classes")
    gone = stage(found.filter(~F.col("kept")).select(F.col("row_key").alias("weekloom_key")), "near-gone")
    left = docs.withColumn("weekloom_key", key).join(gone, "weekloom_key", "left_anti")
    # Rows equal in id and text share a key: one of them.
    again = stage(found.filter(F.col("kept") & ~F.col("blank") & (F.col("n") > 1)).select(F.col("row_key").alias("weekloom_key")), "near-again")
    if not again.isEmpty():
        left = left.join(again, "weekloom_key", "left_anti").unionByName(left.join(again, "weekloom_key", "left_semi").dropDuplicates(["weekloom_key"]))
    return left.select(*docs.columns)
