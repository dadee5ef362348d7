"""Exact ordered operators over raw rows when one key may hold much of the data.

A plain window would put a whole key into one task. Here a key is cut into
ranges of the ordering value, each range is ordered on its own, and a small
table with one row per key and range carries the totals across the cuts. The
results are exact: no row is dropped or sampled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from weekloom.session import stage


def _key(keys: Sequence[str]) -> Column:
    """The key columns as one value that is never null, so that null keys join too."""
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """The rows in ranges of (keys, order), written once, with ``_key`` and the number of the range, ``_piece``.

    Spark samples the ranges from the data, so they hold about equal numbers of
    rows whatever the keys' sizes, and there are as many as the session has
    shuffle partitions. Only balance depends on them, never the result.
    """
    keyed = df.withColumn("_key", _key(keys))
    dealt = keyed.repartitionByRange("_key", *order)
    return stage(dealt.withColumn("_piece", F.spark_partition_id()), name)


def _before() -> WindowSpec:
    """The ranges of the key before this one."""
    return Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "n") -> DataFrame:
    """1-based position of each row within its key, ordered by ``order`` (columns of any orderable type, nulls first)."""
    cut = _ranged(df, keys, order, "numbered")
    offsets = cut.groupBy("_key", "_piece").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_key", "_piece", F.coalesce(F.sum("_rows").over(_before()), F.lit(0)).alias("_offset")
    )
    local = F.row_number().over(Window.partitionBy("_key", "_piece").orderBy(*order))
    return (
        cut.withColumn("_local", local)
        .join(offsets, ["_key", "_piece"])
        .withColumn(out, F.col("_offset") + F.col("_local"))
        .drop("_key", "_piece", "_local", "_offset")
    )


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], suffix: str = "_sum") -> DataFrame:
    """Sums of each column over the rows of the key up to and including this one, as further columns.

    The rows are unique per key and ``order``; nulls count as nothing.
    """
    cut = _ranged(df, keys, order, "summed")
    totals = cut.groupBy("_key", "_piece").agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(cols)])
    offsets = totals.select("_key", "_piece", *[F.coalesce(F.sum(f"_t{i}").over(_before()), F.lit(0)).alias(f"_o{i}") for i in range(len(cols))])
    running = Window.partitionBy("_key", "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.select("*", *[F.coalesce(F.sum(c).over(running), F.lit(0)).alias(f"_s{i}") for i, c in enumerate(cols)])
    return local.join(offsets, ["_key", "_piece"]).select(
        *df.columns, *[(F.col(f"_o{i}") + F.col(f"_s{i}")).alias(f"{c}{suffix}") for i, c in enumerate(cols)])


def hash_order(cols: Sequence[str], seed: int) -> Column:
    """A repeatable pseudo-random ordering value."""
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the last row of each key. An aggregate, so hot keys combine before the shuffle.

    Of rows equal in ``order`` the one with the greatest other values is kept
    (in the order of the columns, maps left out).
    """
    rest = [c for c in df.columns if c not in keys]
    ties = [c for c, kind in df.dtypes if c in rest and c not in order and "map<" not in kind]
    picked = F.max_by(F.struct(*rest), F.struct(*order, *ties)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, "_row.*").select(*df.columns)


def bump_duplicates(df: DataFrame, keys: Sequence[str], ts: str, order: str, out: str = "ts_unique") -> DataFrame:
    """Make instants unique: the c-th repeat of an instant, by ``order``, moves by c microseconds.

    Rows without an instant stay without one.
    """
    numbered = number_rows(df, [*keys, ts], [order], "_n")
    micros = F.unix_micros(F.col(ts).cast("timestamp")) + F.col("_n") - 1
    return numbered.withColumn(out, F.timestamp_micros(micros)).drop("_n")


def next_instant(df: DataFrame, keys: Sequence[str], ts: str, out: str = "next_ts") -> DataFrame:
    """The following instant of the same key, for rows unique per key and instant.

    One row per key and range links the ranges.
    """
    cut = _ranged(df, keys, [ts], "instants")
    heads = cut.groupBy("_key", "_piece").agg(F.min(ts).alias("_head")).select(
        "_key", "_piece", F.lead("_head").over(Window.partitionBy("_key").orderBy("_piece")).alias("_next_head")
    )
    return (
        cut.withColumn("_lead", F.lead(ts).over(Window.partitionBy("_key", "_piece").orderBy(ts)))
        .join(heads, ["_key", "_piece"])
        .withColumn(out, F.coalesce("_lead", "_next_head"))
        .drop("_key", "_piece", "_lead", "_next_head")
    )


# Half-width of the approximate bracket around a wanted quantile, and how exact its ends are.
BRACKET, ACCURACY = 0.002, 10_000


def exact_quantiles(df: DataFrame, keys: Sequence[str], cols: Sequence[str], probs: Sequence[float],
                    bracket: float = BRACKET) -> DataFrame:
    """Exact linear-interpolated quantiles as rows (keys, variable, prob, value).

    One pass brackets every wanted rank between two approximate quantiles. A
    second pass counts the distinct values inside each bracket, and all values
    below it as one. Those counts, a small share of the values, are put in
    order range by range, and running sums over them give exact ranks.
    """
    by = [*keys, "variable"]
    numeric = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    long = numeric.unpivot(list(keys), list(cols), "variable", "value").filter(F.col("value").isNotNull())

    ends = [x for p in probs for x in (max(0.0, p - bracket), min(1.0, p + bracket))]
    sizes = long.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("value").alias("_min"), F.max("value").alias("_max"),
        F.percentile_approx("value", F.array(*[F.lit(float(x)) for x in ends]), ACCURACY).alias("_ends"))
    # Where a bracket would be less than a few ranks wide, all values are inside.
    few = F.col("_n") * (bracket - 1 / ACCURACY) < 4
    wanted = F.array(*[
        F.struct(F.lit(float(p)).alias("prob"), F.when(few, F.col("_min")).otherwise(F.col("_ends")[2 * i]).alias("_low"),
                 F.when(few, F.col("_max")).otherwise(F.col("_ends")[2 * i + 1]).alias("_high")) for i, p in enumerate(probs)])
    brackets = stage(sizes.select(_key(by).alias("_by"), "_n", wanted.alias("_wanted")), "brackets")

    inside = (
        long.withColumn("_by", _key(by)).join(brackets, "_by")
        .select(*by, "_n", "value", F.inline("_wanted"))
        .filter(F.col("value") <= F.col("_high"))
        .groupBy(*by, "_n", "prob", F.when(F.col("value") >= F.col("_low"), F.col("value")).alias("value"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    cut = _ranged(inside, [*by, "prob"], ["value"], "bracketed")
    offsets = cut.groupBy("_key", "_piece").agg(F.sum("_rows").alias("_sum")).select(
        "_key", "_piece", F.coalesce(F.sum("_sum").over(_before()), F.lit(0)).alias("_offset"))
    running = Window.partitionBy("_key", "_piece").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        cut.withColumn("_local", F.sum("_rows").over(running)).join(offsets, ["_key", "_piece"])
        .withColumn("_to", F.col("_offset") + F.col("_local")).withColumn("_from", F.col("_to") - F.col("_rows"))
        .withColumn("_pos", (F.col("_n") - 1) * F.col("prob"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("_from")) & (rank < F.col("_to")), F.col("value")))

    picked = ranked.groupBy(*by, "prob", "_pos").agg(at(F.floor("_pos")).alias("_a"), at(F.ceil("_pos")).alias("_b"))
    share = F.col("_pos") - F.floor("_pos")
    return picked.select(*by, "prob", (F.col("_a") + (F.col("_b") - F.col("_a")) * share).alias("value"))
