"""The trie of conversation prefixes, its subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. Every turn has a key (a hash of
its role and text); a prefix is identified by its depth and by 128 bits of
running sums of random values of (position, key), so prefixes of any length are
numbered without putting a conversation into one task.

Subtree totals are sums over all nodes below. The tree is contracted in rounds,
each of them a rake and a compress:

- rake: every leaf adds its total to its parent and goes;
- compress: a node with one child that comes before its parent and its child in
  the order of removal (few trailing zero bits of the depth first) adds its
  value to the parent, hands its child over to it, and goes. No two neighbours
  go together, and about half of a chain goes per round.

A node keeps the number of its children and the exclusive or of their keys, so
that the last child is known by its key. Rows meet the messages of their
neighbours in one grouping per step; sums combine before the shuffle, so a
parent of very many children is no hot key. Raked nodes know their total;
compressed ones get it when the rounds are undone in reverse order, from the
child they had. Every round is written to the staging folder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import batches, prepare, stage
from weekloom.operators.hot import number_rows, running_sums

# Ids put into one text before the text of all ids of a node is hashed.
CHUNK_IDS = 4096
_HALF = (1 << 32) - 1
_LANES = ["lane0", "lane1", "lane2", "lane3"]
_NODE = ["depth", "k1", "k2"]
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def turn_keys(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, key (hash of role and text), n_bytes (UTF-8 bytes of the text); rows without a conv_id are in no conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("key"),
        F.octet_length(text).cast("long").alias("n_bytes"))


def numbered(keys: DataFrame) -> DataFrame:
    """conv_id, position (from 1, by turn, null first, then key), key, n_bytes."""
    return number_rows(keys, ["conv_id"], ["turn", "key"], "position").select(
        "conv_id", F.col("position").cast("long").alias("position"), "key", "n_bytes")


def _packed(high: Column, low: Column) -> Column:
    return F.shiftleft(high.bitwiseAND(_HALF), 32).bitwiseOR(low.bitwiseAND(_HALF))


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, depth, k1, k2 (the prefix that ends here), p1, p2 (the one before it), n_bytes."""
    one, two = (F.xxhash64(F.lit(seed), "position", "key") for seed in (1, 2))
    lanes = turns.select("conv_id", "position", "n_bytes", one.bitwiseAND(_HALF).alias("lane0"), F.shiftrightunsigned(one, 32).alias("lane1"),
                         two.bitwiseAND(_HALF).alias("lane2"), F.shiftrightunsigned(two, 32).alias("lane3"))
    summed = running_sums(lanes, ["conv_id"], ["position"], _LANES)
    here = [F.col(f"{c}_sum") for c in _LANES]
    before = [F.col(f"{c}_sum") - F.col(c) for c in _LANES]
    return summed.select("conv_id", F.col("position").alias("depth"), _packed(here[0], here[1]).alias("k1"), _packed(here[2], here[3]).alias("k2"),
                         _packed(before[0], before[1]).alias("p1"), _packed(before[2], before[3]).alias("p2"), "n_bytes")


def _id_chunks(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of a node, ascending, as texts of up to CHUNK_IDS ids; the rows come in order."""
    schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])

    def rows():
        node, ids = None, []
        for batch in found:
            for *key, conv_id in zip(*[c.to_pylist() for c in batch.columns]):
                if ids and (key != node or len(ids) >= CHUNK_IDS):
                    yield *node, ids[0], ",".join(map(str, ids))
                    ids = []
                node = key
                ids.append(conv_id)
        if ids:
            yield *node, ids[0], ",".join(map(str, ids))

    return batches(rows(), schema, weigh=lambda r: len(r[4]))


def _id_hashes(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of all texts of a node joined by commas; the rows come in order."""
    schema = pa.schema([("depth", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])

    def rows():
        node, digest = None, None
        for batch in found:
            for *key, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if key != node:
                    if node:
                        yield *node, digest.hexdigest()
                    node, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
        if node:
            yield *node, digest.hexdigest()

    return batches(rows(), schema)


def end_hashes(ends: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 from one row (depth, k1, k2, conv_id) per conversation.

    The ids of a node are joined piece by piece where they lie in order; only
    these pieces meet in one task, which hashes them as they come.
    """
    prepare(ends.sparkSession)
    chunks = ends.select(*_NODE, "conv_id").repartitionByRange(*_NODE, "conv_id").sortWithinPartitions(*_NODE, "conv_id").mapInArrow(
        _id_chunks, "depth long, k1 long, k2 long, first long, ids string")
    return chunks.repartition(*_NODE).sortWithinPartitions(*_NODE, "first").mapInArrow(
        _id_hashes, "depth long, k1 long, k2 long, ends_sha256 string")


# ---- contraction ----------------------------------------------------------------------------

_KEY, _VALUES = ["vc", "vd"], ["leaves", "saved"]
LIVE, RAKED, COMPRESSED = 0, 1, 2
_STATE = ["pc", "pd", *_VALUES, "n", "xc", "xd"]


def _met(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """Rows with what their neighbours send: sums, changed sets of children, a new parent."""
    sent = messages.select(*_KEY, *[F.lit(None).cast("long").alias(c) for c in ("pc", "pd")], *_VALUES, "n", "xc", "xd", "nc", "nd")
    both = rows.select(*_KEY, *_STATE, *[F.lit(None).cast("long").alias(c) for c in ("nc", "nd")]).unionByName(sent)
    return both.groupBy(*_KEY).agg(
        F.coalesce(F.max("nc"), F.max("pc")).alias("pc"), F.coalesce(F.max("nd"), F.max("pd")).alias("pd"),
        *[F.sum(c).alias(c) for c in (*_VALUES, "n")], *[F.bit_xor(c).alias(c) for c in ("xc", "xd")])


def _message(rows: DataFrame, to: tuple[Column, Column], values: bool = False, n: int = 0, x: tuple[Column, Column] | None = None,
             parent: tuple[Column, Column] | None = None) -> DataFrame:
    zero, null = F.lit(0).cast("long"), F.lit(None).cast("long")
    return rows.select(to[0].alias("vc"), to[1].alias("vd"), *[(F.col(c) if values else zero).alias(c) for c in _VALUES],
                       F.lit(n).cast("long").alias("n"), *[v.alias(c) for v, c in zip(x or (zero, zero), ("xc", "xd"))],
                       *[v.alias(c) for v, c in zip(parent or (null, null), ("nc", "nd"))])


def _goes(turn: int) -> Column:
    """Whether a node with one child goes in this round: before its parent and its child in the order of removal."""
    def place(c: str, d: str) -> Column:
        return F.struct(F.col(d).bitwiseAND(-F.col(d)), F.xxhash64(F.lit(turn), F.col(c), F.col(d)), F.col(c))

    mine = place("vc", "vd")
    return (F.col("n") == 1) & (F.col("vd") > 0) & (mine < place("xc", "xd")) & ((F.col("pd") == 0) | (mine < place("pc", "pd")))


def subtree_sums(nodes: DataFrame) -> DataFrame:
    """vc, vd, leaves, saved: the sums of both values over each node's subtree, itself included.

    ``nodes`` has the node (vc, vd), its parent (pc, pd; null for the root,
    whose vd is 0), its number of children n, the exclusive or of their keys
    (xc, xd), and its own values.
    """
    def live_of(table: DataFrame) -> DataFrame:
        return table.filter(F.col("state") == LIVE).select(*_KEY, *_STATE)

    rounds: list[DataFrame] = []
    live = nodes.select(*_KEY, *_STATE)
    while True:
        turn = len(rounds)
        leaf = (F.col("n") == 0) & (F.col("vd") > 0)
        parent, self_, child = (F.col("pc"), F.col("pd")), (F.col("vc"), F.col("vd")), (F.col("xc"), F.col("xd"))
        raked = live.filter(leaf)
        rest = _met(live.filter(~leaf), _message(raked, parent, values=True, n=-1, x=self_))
        gone = _goes(turn)
        marked = stage(rest.withColumn("gone", gone), f"trie-raked-{turn}")
        out, stay = marked.filter("gone"), marked.filter("NOT gone")
        swap = tuple(a.bitwiseXOR(b) for a, b in zip(self_, child))
        kept = _met(stay, _message(out, parent, values=True, x=swap).unionByName(_message(out, child, parent=parent)))
        done = [(kept, LIVE), (raked, RAKED), (out, COMPRESSED)]
        table = stage(reduce(DataFrame.unionByName, [t.select(*_KEY, *_STATE, F.lit(s).alias("state")) for t, s in done]), f"trie-round-{turn}")
        rounds.append(table)
        live = live_of(table)
        if live.filter(F.col("vd") > 0).isEmpty():
            break
    known = live.select(*_KEY, *_VALUES)
    for turn in range(len(rounds) - 1, -1, -1):
        table = rounds[turn]
        own = table.filter(F.col("state") == RAKED).select(*_KEY, *_VALUES)
        chained = table.filter(F.col("state") == COMPRESSED).select(*_KEY, F.col("xc"), F.col("xd"), *[F.col(c).alias(f"own_{c}") for c in _VALUES])
        below = known.select(F.col("vc").alias("xc"), F.col("vd").alias("xd"), *_VALUES)
        undone = chained.join(below, ["xc", "xd"]).select(*_KEY, *[(F.col(f"own_{c}") + F.col(c)).alias(c) for c in _VALUES])
        # A round's nodes are those that go in it and those that outlive it: the tables shrink with the rounds.
        known = stage(known.unionByName(own).unionByName(undone), f"trie-known-{turn}")
    return known


def nodes(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per node of the trie: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` has conv_id, position (1, 2, … in each conversation), key and
    n_bytes; ``members`` has each conv_id once, also those without turns, which
    end at the root (depth 0). conv_id is the smallest member of the node, and
    with depth names it. n_leaves counts childless nodes of the subtree,
    saved_tokens sums (n_convs - 1) x n_bytes over it. ends_sha256 hashes the
    ascending ids of the conversations that end here, joined by commas.
    No members: no rows.
    """
    at = stage(prefixes(turns), "trie-prefixes")
    top = members.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least")).first()  # one row
    zero = F.lit(0).cast("long")
    if not top["n"]:
        empty = ", ".join(f"{c} long" for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"))
        return members.sparkSession.createDataFrame([], empty + ", ends_sha256 string")
    own = at.groupBy(*_NODE).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("p1").alias("p1"),
                                 F.max("p2").alias("p2"), F.max("n_bytes").alias("n_bytes"))
    found = stage(own, "trie-nodes")
    above = found.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("pc"))
    columns = [*_NODE, "conv_id", "pc", "n_convs", "n_bytes"]
    root = members.sparkSession.range(1).select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(top["least"]).cast("long").alias("conv_id"),
                                                F.lit(None).cast("long").alias("pc"), F.lit(top["n"]).cast("long").alias("n_convs"), zero.alias("n_bytes"))
    first = found.filter("depth = 1").withColumn("pc", F.lit(top["least"]).cast("long"))
    deeper = found.filter("depth > 1").join(above, ["depth", "p1", "p2"])
    last = at.groupBy("conv_id").agg(F.max_by(F.struct(*_NODE), "depth").alias("node"))
    ends = members.select("conv_id").join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(F.col(f"node.{c}"), zero).alias(c) for c in _NODE])
    every = reduce(DataFrame.unionByName, [t.select(*columns) for t in (root, first, deeper)])
    named = stage(every.join(end_hashes(ends), _NODE, "left").drop("k1", "k2"), "trie-named")
    here = named.select(F.col("conv_id").alias("vc"), F.col("depth").alias("vd"), "pc", F.when(F.col("pc").isNotNull(), F.col("depth") - 1).alias("pd"),
                        zero.alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"), zero.alias("n"), zero.alias("xc"), zero.alias("xd"))
    children = _message(here.filter(F.col("pc").isNotNull()), (F.col("pc"), F.col("pd")), n=1, x=(F.col("vc"), F.col("vd")))
    start = stage(_met(here, children).withColumn("leaves", F.when(F.col("n") == 0, 1).otherwise(0).cast("long")), "trie-start")
    totals = subtree_sums(start).join(start.select(*_KEY, F.col("n").alias("n_children")), _KEY)
    return named.join(totals, (named["conv_id"] == totals["vc"]) & (named["depth"] == totals["vd"])).select(
        "conv_id", "depth", F.col("pc").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


def trie(conversations: DataFrame) -> DataFrame:
    """The nodes of a table with conv_id, turn, role and text (see ``nodes``).

    Turns are ordered by turn, null first; ties by a hash of role and text, and
    repeated rows are turns of their own. A null role or text is empty. Rows
    with a null conv_id belong to no conversation. Very long texts only pass
    through a hash; a conversation of any length is spread over tasks. An empty
    table gives no rows. Other columns are not read.
    """
    turns = numbered(turn_keys(conversations))
    return nodes(turns, turns.select("conv_id").distinct())
