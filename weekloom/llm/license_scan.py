"""Licence texts in documents: winnowed fingerprints pick candidates, banded alignment reports what matched.

Templates are cut into word k-grams; of every WINNOW neighbouring k-grams the
one with the least hash is a fingerprint, and an inverted index maps it to its
places in the templates. A document is winnowed in the same way, k-grams with a
word of no template apart, so any run of WINNOW + K - 1 template words yields a
common fingerprint. Fingerprints that meet on nearly one diagonal (place in the
document minus place in the template) are a candidate region. The region is
aligned with the template word by word inside a band around that diagonal.

Both steps work document by document in one stage: nothing is shuffled, and the
index holds the templates only.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import batches, keyed_texts
from weekloom.llm.license_texts import TEMPLATES

WORD = re.compile(r"\w+")
K, WINNOW = 3, 3
# Diagonals of one candidate may drift this far, or half a template's words if that is less.
BAND = 8
MATCH, MISMATCH, GAP = 2, -1, -1
# Share of a template, or number of its words, from which a match is reported.
MIN_SHARE, MIN_WORDS = 0.75, 25
TOP = np.uint64((1 << 64) - 1)
GOLD = np.uint64(0x9E3779B97F4A7C15)
REGION = pa.struct([("shift", pa.int64()), ("first_word", pa.int64()), ("words", pa.list_(pa.string())), ("starts", pa.list_(pa.int64())),
                    ("ends", pa.list_(pa.int64()))])
CANDIDATE = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("regions", pa.list_(REGION))])
FOUND = pa.schema([("doc_id", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("n_words", pa.int64()),
                   ("start", pa.int64()), ("end", pa.int64()), ("template_start", pa.int64()), ("template_end", pa.int64())])


@dataclass
class Index:
    """Vocabulary of the templates and their fingerprints."""

    words: dict[str, list[str]]
    codes: dict[str, int]
    places: dict[int, list[tuple[str, int]]]


def words_of(text: str) -> list[str]:
    """Lower-case words. Split first: lower case may cut a word in two, as it does with a dotted capital I."""
    return [w.lower() for w in WORD.findall(text)]


def kgrams(codes: np.ndarray) -> np.ndarray:
    """Hash of the k-gram at each place, TOP where a word is of no template (code 0)."""
    n = len(codes) - K + 1
    out, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(K):
        part = codes[j:j + n]
        out = (out ^ (out >> np.uint64(29))) * GOLD + part
        known &= part != 0
    return np.where(known, out, TOP)


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Places of the fingerprints: the last least hash of every window; a short input keeps its least."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    width = min(WINNOW, len(hashes))
    view = np.lib.stride_tricks.sliding_window_view(hashes, width)[:, ::-1]
    places = np.unique(np.arange(len(view)) + width - 1 - view.argmin(1))
    return places[hashes[places] != TOP]


def index_of(templates: Mapping[str, str]) -> Index:
    words = {name: words_of(text) for name, text in templates.items()}
    codes = {w: xxhash.xxh64_intdigest(w.encode()) | 1 for ws in words.values() for w in ws}
    places: dict[int, list[tuple[str, int]]] = defaultdict(list)
    for name, ws in words.items():
        if len(ws) >= K:
            hashes = kgrams(np.array([codes[w] for w in ws], np.uint64))
            for p in winnow(hashes).tolist():
                places[int(hashes[p])].append((name, p))
    return Index(words, codes, dict(places))


def band_of(size: int) -> int:
    return min(BAND, size // 2)


def regions(text: str, index: Index) -> list[tuple[str, int, int, int, int]]:
    """(template, diagonal, first word, last word, hits) of every candidate of a text."""
    words = words_of(text)
    if len(words) < K:
        return []
    get = index.codes.get
    codes = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
    # Runs of template words only: most texts have none long enough.
    known = codes != 0
    if not (known[:-2] & known[1:-1] & known[2:]).any():
        return []
    hashes = kgrams(codes)
    met: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for p in winnow(hashes).tolist():
        for name, q in index.places.get(int(hashes[p]), ()):
            met[name].append((p - q, p))
    out = []
    for name, hits in met.items():
        size = len(index.words[name])
        band = band_of(size)
        hits.sort()
        group: list[tuple[int, int]] = []
        for shift, p in [*hits, (1 << 60, 0)]:
            if group and shift - group[0][0] > band:
                shifts = [s for s, _ in group]
                middle = sorted(shifts)[len(shifts) // 2]
                out.append((name, middle, max(0, shifts[0] - band), min(len(words), shifts[-1] + size + band), len(group)))
                group = []
            group.append((shift, p))
    return out


def candidates(texts: DataFrame, index: Index) -> DataFrame:
    """One row per document and template with the words of each candidate region and their places in the text."""
    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                near = regions(text, index)
                if near:
                    # The words of regions(), with their places in the text.
                    spots = [(m.group().lower(), m.start(), m.end()) for m in WORD.finditer(text)]
                    of: dict[str, list[dict]] = defaultdict(list)
                    for name, shift, lo, hi, _ in near:
                        words, starts, ends = (list(c) for c in zip(*spots[lo:hi]))
                        of[name].append({"shift": shift, "first_word": lo, "words": words, "starts": starts, "ends": ends})
                    yield from ((doc_id, name, cut) for name, cut in of.items())

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(found(parts), CANDIDATE, most_rows=500)
    return texts.mapInArrow(run, "doc_id long, license string, regions array<struct<shift:long,first_word:long,words:array<string>,starts:array<long>,ends:array<long>>>")


def align(template: list[str], words: list[str], diagonal: int, band: int) -> tuple[int, int, int, int, int]:
    """Best local alignment within the band: (matched words, template first and end, region first and end).

    One row of the table per template word, as an array over the band: place o
    of row i is region word i + diagonal - band + o. A run of gaps along a row
    is a running maximum, since each gap costs the same. Of equal scores the
    first in template order, then in region order, is taken; a way back prefers
    a pair of words, then a gap in the region, then one in the template.
    """
    codes: dict[str, int] = {}
    left = np.array([codes.setdefault(w, len(codes)) for w in template], np.int32)
    right = np.array([codes.setdefault(w, len(codes)) for w in words], np.int32)
    width = 2 * band + 1
    gaps = GAP * np.arange(width)
    ways = np.zeros((len(left) + 1, width), np.int8)
    above = np.zeros(width, np.int64)
    best, best_at = 0, (0, 0)
    for i in range(1, len(left) + 1):
        place = np.arange(i + diagonal - band, i + diagonal + band + 1)  # 1 is the region's first word
        inside = (place >= 1) & (place <= len(right))
        if not inside.any():
            above = np.zeros(width, np.int64)
            continue
        same = right[np.clip(place - 1, 0, len(right) - 1)] == left[i - 1]
        pair = above + np.where(same, MATCH, MISMATCH)
        down = np.append(above[1:], 0) + GAP
        top = np.where(inside, np.maximum(np.maximum(pair, down), 0), 0)
        # The best cell of this row further left, less a gap for every step from it.
        along = np.maximum.accumulate(top - gaps) + gaps
        row = np.where(inside, np.maximum(top, along), 0)
        beside = np.append(0, row[:-1]) + GAP
        ways[i] = np.select([row <= 0, row == pair, row == down, row == beside], [0, 1, 2, 3], 0)
        most = int(row.max())
        if most > best:
            best, best_at = most, (i, int(place[row.argmax()]))
        above = row
    i, j = best_at
    matched = 0
    while i > 0 and 0 <= (o := j - (i + diagonal - band)) < width and ways[i, o]:
        step = ways[i, o]
        matched += step == 1 and template[i - 1] == words[j - 1]
        i, j = (i - 1, j - 1) if step == 1 else (i - 1, j) if step == 2 else (i, j - 1)
    return int(matched), i, best_at[0], j, best_at[1]


def occurrences(template: list[str], cuts: list[dict]) -> list[tuple]:
    """Of the regions of one document and template, (matched, template start and end, start and end in the text) of each occurrence.

    Phrases that a template repeats put an occurrence on several diagonals; of
    overlapping spans the one with most words stays, of equal ones the first.
    """
    every = []
    for c in cuts:
        matched, t0, t1, w0, w1 = align(template, c["words"], c["shift"] - c["first_word"], 2 * band_of(len(template)))
        if matched and (matched / len(template) >= MIN_SHARE or matched >= MIN_WORDS):
            every.append((matched, t0, t1, c["starts"][w0], c["ends"][w1 - 1]))
    kept: list[tuple] = []
    starts: list[int] = []
    for one in sorted(every, key=lambda x: (-x[0], x[3], x[1])):
        at = bisect_left(starts, one[4])  # kept spans are apart, so only the last that begins before the end can overlap
        if not at or kept[at - 1][4] <= one[3]:
            starts.insert(at, one[3])
            kept.insert(at, one)
    return kept


def aligned(near: DataFrame, index: Index) -> DataFrame:
    """Coverage and spans of the candidates that hold enough of their template."""
    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part in parts:
            for c in part.to_pylist():
                template = index.words[c["license"]]
                for matched, t0, t1, start, end in occurrences(template, c["regions"]):
                    yield (c["doc_id"], c["license"], round(matched / len(template), 6), matched, start, end, t0, t1)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(found(parts), FOUND)
    return near.mapInArrow(run, "doc_id long, license string, coverage double, n_words long, start long, end long, template_start long, template_end long")


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences found: doc_id, license, coverage (share of the template's words), n_words, start and end (code points), template_start and
    template_end (words), one row per occurrence.

    A null or empty text holds none. Null and repeated ids stay, each row for
    itself. Templates of fewer than three words are never found. A short
    template inside a longer one is reported next to it, and so are templates
    that share MIN_WORDS words with the one that is there. Where a text drifts
    from a template by more than the band, its parts are rows of their own.
    Very long texts are scanned whole; an empty table gives no rows. Other
    columns are not read.
    """
    index = index_of(templates)
    return aligned(candidates(keyed_texts(docs, id_col, text_col), index), index)
