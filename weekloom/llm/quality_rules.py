"""Rules on whole texts with cutoffs whose rate of false rejections is bounded.

Every rule is a share between 0 and 1 and rejects above a cutoff. The labelled
good documents of a stratum are a holdout: no cutoff of the fixed grid was
fitted to them. A cutoff is certified if the exact binomial test rejects "it
rejects more than ``alpha`` / rules of the good documents" at level ``delta``
/ (strata x rules), going down the grid from the loosest cutoff and stopping at
the first that fails (fixed-sequence testing), so that with probability
1 - ``delta`` all certified cutoffs of all strata hold at once, and all rules
together reject at most ``alpha``. Of the certified cutoffs the one that
separates the labels best is used; without enough labels a stratum has none
and only the base rule rejects.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekloom.llm.common import as_batch, labels_of, prepare, stage

WORD = re.compile(r"[^ \t-\r]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
# Share columns that the rules cut, and the grid from loose to strict.
RULES = ("symbol_share", "dup_line_share", "repeat_share", "run_share", "upper_share")
GRID = (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.03)
ALPHA, DELTA = 0.02, 0.05
# A good document rejected counts as much as so many bad ones that stay.
COST = 20
# Up to so many strata the cutoffs are sent to all executors; beyond they are joined.
SMALL_STRATA = 10_000
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
FEATURES = pa.schema([
    ("doc_id", pa.int64()), ("stratum", pa.string()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("n_lines", pa.int64()), ("n_runs", pa.int64()),
    ("n_upper", pa.int64())])


def repeated_words(words: list[str], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur at least twice, the first one included.

    Windows are compared by a 64-bit rolling hash of the words' hashes.
    """
    n = len(words) - size + 1
    if n < 2:
        return 0
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = codes[:n].copy()
    for k in range(1, size):
        rolled *= MULTIPLIER
        rolled += codes[k:n + k]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += twice
    edges[size:size + n] -= twice
    return int((np.cumsum(edges)[:-1] > 0).sum())


def n_upper(text: str) -> int:
    """Characters that lower case changes."""
    lower = text.lower()
    if len(lower) != len(text):
        return sum(c != c.lower() for c in text)
    wide = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4") for t in (text, lower)]
    return int((wide[0] != wide[1]).sum())


def measure(text: str) -> tuple:
    """Counts of one text; see FEATURES."""
    words = WORD.findall(text)
    lines = text.split("\n")
    seen: set[str] = set()
    dup = full = 0
    for line in lines:
        if line and WORD.search(line):
            full += 1
            dup += line in seen
            seen.add(line)
    runs = sum(map(str.__eq__, words[1:], words)) if len(words) > 1 else 0
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeated_words(words), full, runs, n_upper(text))


PREFIX = "weekloom_"  # of the columns added to whole rows, so that no column of the caller is hidden


def with_measures(docs: DataFrame, text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """All columns of the rows, then their stratum and counts under PREFIX; a null text has none."""
    prepare(docs.sparkSession)
    own, names = [f.name for f in docs.schema], [f.name for f in FEATURES][2:]
    rows = docs.select("*", F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias(f"{PREFIX}stratum"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias(f"{PREFIX}text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            counted = np.array([measure(t) for t in part.column(part.num_columns - 1).to_pylist()], np.int64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *[pa.array(c) for c in counted.T]],
                                             [*own, f"{PREFIX}stratum", *[PREFIX + n for n in names]])

    schema = T.StructType([*rows.schema.fields[:-1], *[T.StructField(PREFIX + n, T.LongType()) for n in names]])
    return rows.mapInArrow(run, schema)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row of counts per document."""
    counted = with_measures(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col), F.col(stratum_col)), text_col, stratum_col)
    return counted.select("doc_id", *[F.col(PREFIX + f.name).alias(f.name) for f in FEATURES if f.name != "doc_id"])


def shares() -> dict[str, Column]:
    def part(top: str, below: str) -> Column:
        return F.coalesce(F.col(top) / F.when(F.col(below) > 0, F.col(below)), F.lit(0.0))
    return {"symbol_share": part("n_symbols", "word_chars"), "dup_line_share": part("n_dup_lines", "n_lines"),
            "repeat_share": part("n_repeat_words", "n_words"), "run_share": part("n_runs", "n_words"), "upper_share": part("n_upper", "word_chars")}


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X of n draws at rate p, exact: the level at which a true rate of p or more is refuted."""
    if n == 0 or k >= n:
        return 1.0
    log_p, log_q, top = math.log(p), math.log1p(-p), math.lgamma(n + 1)
    terms = [top - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q for i in range(k + 1)]
    most = max(terms)
    return min(1.0, math.exp(most) * sum(math.exp(t - most) for t in terms))


def certified(n_good: int, good: list[int], bad: list[int], level: float, rate: float) -> float:
    """The cutoff to use, or 2.0 (above every share) where none is certified.

    ``good`` and ``bad`` count the labelled documents above each cutoff of GRID.
    """
    best, use = 0, 2.0
    for cut, g, b in zip(GRID, good, bad):
        if binomial_tail(g, n_good, rate) > level:
            break
        if b - COST * g > best:
            best, use = b - COST * g, cut
    return use


def cutoffs(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per stratum: the certified cutoff of every rule."""
    marked = counted.join(labels_of(labels, "quality"), "doc_id").filter(F.col("quality").isNotNull() & ~base_failed())
    share = shares()
    marked = marked.select("stratum", "quality", *[share[r].alias(r) for r in RULES])
    good, bad = (F.col("quality") == 1), (F.col("quality") == 0)
    sums = marked.groupBy("stratum").agg(
        F.count_if(good).alias("n_good"),
        *[F.count_if(which & (F.col(r) > c)).alias(f"{r}_{kind}_{k}") for r in RULES for kind, which in (("good", good), ("bad", bad)) for k, c in enumerate(GRID)])
    table = stage(sums.select("stratum", "n_good", *[F.array(*[F.col(f"{r}_{kind}_{k}") for k in range(len(GRID))]).alias(f"{r}_{kind}")
                                                    for r in RULES for kind in ("good", "bad")]), "rule-counts")
    level = delta / (len(RULES) * max(1, table.count()))
    rate = alpha / len(RULES)
    schema = pa.schema([("stratum", pa.string()), *[(f"{r}_cut", pa.float64()) for r in RULES]])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield as_batch([(x["stratum"], *[certified(x["n_good"], x[f"{r}_good"], x[f"{r}_bad"], level, rate) for r in RULES])
                            for x in part.to_pylist()], schema)

    return table.mapInArrow(run, "stratum string, " + ", ".join(f"{r}_cut double" for r in RULES))


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id",
          text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Counts, base verdict, reasons and final verdict of every document.

    A null or empty text has no words and fails the base rule. A null stratum
    is the stratum "". Rows with equal or null ids are judged each for itself;
    labels of null ids count for nothing. Without labels only the base rule
    rejects. Other columns are not read.
    """
    counted = stage(measures(docs, id_col, text_col, stratum_col), "rule-measures")
    cuts = stage(cutoffs(counted, labels, alpha, delta), "rule-cutoffs")
    return verdicts(counted, cuts).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                          "base_failed", "kept", "stratum", "reasons")


def verdicts(counted: DataFrame, cuts: DataFrame) -> DataFrame:
    """The counts with base_failed, reasons and kept."""
    few, share = cuts.count() <= SMALL_STRATA, shares()
    joined = counted.join(F.broadcast(cuts) if few else cuts, "stratum", "left")
    reasons = F.filter(F.array(
        F.when(base_failed(), F.lit("base")),
        *[F.when(share[r] > F.coalesce(F.col(f"{r}_cut"), F.lit(2.0)), F.lit(r)) for r in RULES]), lambda x: x.isNotNull())
    return (joined.withColumn("base_failed", base_failed()).withColumn("reasons", reasons)
            .withColumn("kept", F.size("reasons") == 0))


def keep(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id",
         text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. Texts are measured once more instead of being shuffled to their verdicts."""
    cuts = stage(cutoffs(stage(measures(docs, id_col, text_col, stratum_col), "rule-measures"), labels, alpha, delta), "rule-cutoffs")
    rows = with_measures(docs, text_col, stratum_col)
    counts = [f.name for f in FEATURES if f.name != "doc_id"]
    rows = rows.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *[F.col(PREFIX + c).alias(c) for c in counts])
    return verdicts(rows, cuts).filter("kept").select("row.*")
