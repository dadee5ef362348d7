"""Runs of repeated words, found by a branching-tandem test on an enhanced suffix array.

A run is a stretch of words with smallest period q that no neighbouring word
extends. Its last square (two equal halves of q words) is a branching tandem
repeat: the suffixes at both halves share exactly q words. Such squares are
found without building tree nodes:

1. A suffix array over all words of a batch of documents, by prefix doubling
   that sorts only suffixes still tied. The ranks of every doubling step are
   kept; two places have equal ranks at step j if their next 2**j words agree.
2. Common prefixes of neighbours in the suffix array from these ranks, and for
   each value the interval of suffixes that share it (previous and next smaller
   value by pointer jumping).
3. In every interval of depth d, each suffix i of every child but the largest
   looks up whether i + d or i - d lies in the interval and in another child.
4. The squares found rotate to the left as far as the words allow, in jumps of
   powers of two, and squares that cover the same stretch are one run, with the
   smallest period.

The suffixes looked at are at most n log n per document; documents are only
batched, never compared with each other. A task holds one batch: about
``BATCH_WORDS`` words or one longer document, with 4 bytes per word and
doubling step.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weekloom.llm.common import as_batch, keyed_texts

# A run counts from this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
BATCH_WORDS = 200_000
# Suffixes looked up at a time.
LOOKUPS = 2_000_000

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("strongest", _RUN), ("collapsed", pa.string())])


def doubled_ranks(first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array, and the ranks after each doubling step with one more place at the end.

    ``first`` codes each place's word (different in every document), ``end`` is
    the end of its document. The last ranks are the inverse suffix array.
    """
    n = len(first)
    order = np.argsort(first, kind="stable")
    rank = np.full(n + 1, -1, np.int32)
    slots, places, keys = np.arange(n), order, first[order]
    sa = order.copy()
    levels: list[np.ndarray] = []
    step = 0
    while True:
        new = np.ones(len(slots), bool)
        # A tie never crosses a gap between slots: tied suffixes stand side by side.
        new[1:] = keys[1:] != keys[:-1]
        heads = slots[new][np.cumsum(new) - 1]
        rank = rank.copy()
        rank[places] = heads
        sa[slots] = places
        levels.append(rank)
        alone = new & np.append(new[1:], True)
        slots, places = slots[~alone], places[~alone]
        if not len(slots):
            return sa, levels
        step = 1 << (len(levels) - 1)
        ahead = places + step
        second = np.where(ahead < end[places], rank[np.minimum(ahead, n)], -1).astype(np.int64)
        keys = rank[places].astype(np.int64) * (n + 1) + second + 1
        by_key = np.argsort(keys, kind="stable")
        places, keys = places[by_key], keys[by_key]


def common_prefixes(sa: np.ndarray, levels: Sequence[np.ndarray]) -> np.ndarray:
    """Words each suffix shares with the one before it in the suffix array; -1 before the first and after the last."""
    n = len(sa)
    shared = np.zeros(n + 1, np.int64)
    shared[0] = shared[n] = -1
    at = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    left, right = sa[at - 1].copy(), sa[at].copy()
    total = np.zeros(len(at), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        same = (levels[j][left] == levels[j][right]).astype(np.int64) << j
        left += same
        right += same
        total += same
    shared[at] = total
    return shared


def previous_smaller(values: np.ndarray) -> np.ndarray:
    """For each index with a positive value the last one before it with a smaller value; values[0] is negative."""
    found = np.arange(-1, len(values) - 1)
    open_ = np.flatnonzero(values > 0)
    while len(open_):
        open_ = open_[values[found[open_]] >= values[open_]]
        found[open_] = found[found[open_]]
    return found


def branching_squares(sa: np.ndarray, levels: Sequence[np.ndarray], begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, half) of all squares whose halves share exactly ``half`` words as suffixes."""
    none = np.zeros(0, np.int64)
    shared = common_prefixes(sa, levels)
    n, inverse = len(sa), levels[-1]
    cuts = np.flatnonzero(shared > 0)
    if not len(cuts):
        return none, none
    low = previous_smaller(shared)[cuts]
    high = (n - previous_smaller(shared[::-1])[::-1])[cuts]  # one past the interval
    depth = shared[cuts]
    # Cuts of one interval have its left end and depth in common; cuts themselves ascend.
    by_interval = np.lexsort((cuts, depth, low))
    cuts, low, high, depth = cuts[by_interval], low[by_interval], high[by_interval], depth[by_interval]
    head = np.ones(len(cuts), bool)
    head[1:] = (low[1:] != low[:-1]) | (depth[1:] != depth[:-1])
    # The child before the first cut, and the one that starts at each cut.
    after = np.append(cuts[1:], 0)
    last = np.append(head[1:], True)
    after[last] = high[last]
    interval = np.cumsum(head) - 1
    group = np.concatenate([interval[head], interval])
    start = np.concatenate([low[head], cuts])
    size = np.concatenate([cuts[head] - low[head], after - cuts])
    bounds = np.concatenate([np.flatnonzero(head), np.arange(len(cuts))])
    by_group = np.lexsort((-size, group))
    group, start, size, bounds = group[by_group], start[by_group], size[by_group], bounds[by_group]
    small = np.ones(len(group), bool)
    small[0], small[1:] = False, group[1:] == group[:-1]  # all but the largest child
    start, size, bounds = start[small], size[small], bounds[small]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    reach = np.cumsum(size)
    at = 0
    while at < len(size):
        to = max(at + 1, int(np.searchsorted(reach, (reach[at - 1] if at else 0) + LOOKUPS)))
        many = size[at:to]
        which = np.repeat(np.arange(at, to), many)
        slot = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + start[which]
        place, d = sa[slot], depth[bounds[which]]
        for other, inside in ((place + d, place + d < end[place]), (place - d, place - d >= begin[place])):
            r = inverse[np.where(inside, other, 0)]
            child = start[which]
            hit = inside & (r >= low[bounds[which]]) & (r < high[bounds[which]]) & ~((r >= child) & (r < child + size[which]))
            found.append((np.minimum(place, other)[hit], d[hit]))
        at = to
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(codes: np.ndarray, sizes: Sequence[int], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """Rows (start, end, period) over the places of a batch, ordered by start and period.

    ``codes`` are the words of all documents in a row, ``sizes`` their numbers
    of words. ``least_periods`` is at least 2.
    """
    sizes = np.asarray(sizes, np.int64)
    if not len(codes):
        return np.zeros((0, 3), np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(np.cumsum(sizes), sizes)
    begin = end - np.repeat(sizes, sizes)
    sa, levels = doubled_ranks(doc * (int(codes.max()) + 1) + codes, end)
    at, half = branching_squares(sa, levels, begin, end)
    last = at + 2 * half
    start = at.copy()
    for j in range(len(levels) - 1, -1, -1):
        back = start - (1 << j)
        held = back >= begin[at]
        back = np.where(held, back, 0)
        start = np.where(held & (levels[j][back] == levels[j][back + half]), back, start)
    length = last - start
    long = length >= np.maximum(least_words, least_periods * half)
    rows = np.stack([start[long], last[long], half[long]], axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[first]  # the smallest period of a stretch
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def strongest(runs: Sequence[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The (start, length, period) with the greatest exact length / period; ties: smallest start, then period."""
    best = None
    for run in runs:  # by start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _analysed(group: list[tuple[int | None, list[bytes]]]) -> list[tuple]:
    table: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = [len(w) for _, w in group]
    codes = np.fromiter((c for _, w in group for c in map(table.__getitem__, w)), np.int64, sum(sizes))
    runs = runs_of(codes, sizes)
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    ends = np.cumsum(sizes)
    cut = np.searchsorted(runs[:, 0], np.append(0, ends))
    out = []
    for k, (doc_id, words) in enumerate(group):
        begin = int(ends[k]) - sizes[k]
        mine = [(a - begin, z - a, q) for a, z, q in runs[cut[k]:cut[k + 1]].tolist()]
        if mine:
            words = [w for w, keep in zip(words, kept[begin:ends[k]].tolist()) if keep]
        best = strongest(mine)
        named = [dict(zip(("start", "length", "period"), r)) for r in mine]
        out.append((doc_id, sizes[k], named, best and dict(zip(("start", "length", "period"), best)), b" ".join(words).decode()))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        group: list = []
        held = 0
        texts = batch.column(1).cast(pa.binary())
        for k, doc_id in enumerate(batch.column(0).to_pylist()):
            words = texts[k].as_py().split()  # bytes split at ASCII white space only
            if group and held + len(words) > BATCH_WORDS:
                yield as_batch(_analysed(group), _OUT)
                group, held = [], 0
            group.append((doc_id, words))
            held += len(words)
        if group:
            yield as_batch(_analysed(group), _OUT)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, runs, strongest, collapsed.

    ``runs`` are structs (start, length, period) in words, by start and period;
    ``strongest`` is the one with most periods or null; ``collapsed`` are the
    words, one space between, without those that a run holds after its first
    period. Words are cut at ASCII white space.

    Null or empty text: no words, no runs, an empty ``collapsed``. A null id
    stays null and repeated rows or ids give a row each, as documents are
    independent of each other. Ties go by start, then period. Very long texts
    are analysed whole, in one task. An empty table gives an empty table. Other
    columns are not read, whatever their names.
    """
    rows = keyed_texts(docs, id_col, text_col)
    return rows.mapInArrow(_scan, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
                                   "strongest struct<start: long, length: long, period: long>, collapsed string")
