"""Benchmark leaks, also with other numbers, names or units; DataFrame functions only.

Texts become templates: numbers, names and units turn into typed placeholders.
Windows of template words of the benchmark are hash-joined with those of the
documents. Matches on one diagonal (document position minus item position) are
one occurrence; there the values behind the placeholders are lined up, and the
occurrence counts if every value of the item stands for one value of the
document throughout, that is, if the question was re-parameterised consistently
(or not at all).

Whether a capitalised word is a name does not depend on what stands before it:
every one is, but for the usual beginnings of sentences, on both sides alike.

A window of placeholders only is hashed with its words as they are, since its
template fits any list of numbers or names; one fixed word is enough for a
template. How much an occurrence says is judged on all of its words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import stage

WINDOW = 8
# An occurrence with other values needs so many words that are no placeholders, or all those of an item with fewer,
# and so many words that are no exchanged names.
FIXED_WORDS = 5
# Matched words of one item in a document from which it is leaked; all words of a shorter item.
LEAKED_WORDS = 13
# Items of fewer words cannot be told from ordinary text and are not searched.
LEAST_WORDS = 5
# Up to so many benchmark windows (16 bytes and a key each) go to every executor; beyond, both sides are shuffled.
SMALL_WINDOWS = 1_000_000
# Units that follow a number.
UNITS = (
    "kg g mg lb lbs oz ton tons km m cm mm mile miles foot feet inch inches yard yards l ml liter liters litre litres "
    "hour hours hr minute minutes min second seconds sec day days week weeks month months year years percent dollar dollars "
    "cent cents euro euros pound pounds usd eur gbp mph kmh degree degrees meter meters metre metres gram grams apples items people"
).split()
# Numbers written as words, and words that begin sentences more often than they are names.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
STARTERS = (
    "a an the in on at if how what when where which who whose why is are was were will would does do did can could should may has have had "
    "there this that these those it its he she they we you i his her their our your my for from to of with by as and but or so not no "
    "each every some all many most after before then than while suppose find given let calculate compute determine solve explain add subtract multiply divide evaluate simplify convert write name list "
    "show prove choose complete state describe"
).split()
NAME = "\x01"
# Types of placeholders; a word that stays has 0.
NUMBER, PERSON, UNIT = 1, 2, 3
PLACES = "array<struct<place: int, window: bigint>>"


def words(text: Column) -> Column:
    """Lower-case words and numbers in order; a word that begins with a capital letter carries a mark, wherever it stands."""
    marked = F.when(text.contains(NAME), F.translate(text, NAME, " ")).otherwise(text)
    marked = F.regexp_replace(marked, r"(?<![\p{L}\p{M}])(?=\p{Lu})", NAME)
    return F.regexp_extract_all(F.lower(marked), F.lit(r"\x01?\p{L}[\p{L}\p{M}]*+|\p{N}++(?:[.,:/]\p{N}++)*+"), F.lit(0))


def is_number(word: Column) -> Column:
    return ((word >= "0") & (word < ":")) | word.isin(*NUMBER_WORDS, *[NAME + w for w in NUMBER_WORDS])


def is_name(word: Column) -> Column:
    """A capitalised word that is no usual beginning of a sentence."""
    return (word < "\x02") & ~word.isin(*[NAME + w for w in STARTERS])


# ``all_words`` and ``hashes`` below have to be columns of a table: an expression would run anew for every word.


def slot(all_words: Column, word: Column, i: Column) -> Column:
    """Type of the placeholder a word becomes, null where it stays."""
    return (F.when(is_number(word), NUMBER).when(is_name(word), PERSON)
            .when((i > 0) & is_number(F.get(all_words, i - 1)) & word.isin(*UNITS), UNIT))


def template(all_words: Column) -> Column:
    """Hash of every template word."""
    return F.transform(all_words, lambda w, i: F.coalesce(slot(all_words, w, i).cast("long"), F.xxhash64(F.ltrim(w, F.lit(NAME)))))


def windows(all_words: Column, hashes: Column, size: int) -> Column:
    """Place and hash of every window of ``size`` template words; of the words themselves where all are placeholders."""
    def of(h: Column, i: Column) -> Column:
        each = [h, *[F.get(hashes, i + k) for k in range(1, size)]]
        # Left to right: the first fixed word ends the test.
        open_words = reduce(lambda a, b: a & b, [(x >= NUMBER) & (x <= UNIT) for x in each])
        return F.when(open_words, F.xxhash64(F.lit(-size), F.slice(all_words, i + 1, size))).otherwise(F.xxhash64(F.lit(size), *each))
    return F.when(F.size(hashes) >= size, F.transform(
        F.slice(hashes, 1, F.size(hashes) - (size - 1)), lambda h, i: F.struct(i.alias("place"), of(h, i).alias("window")))).otherwise(F.array().cast(PLACES))


def items_of(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per item: its words, their slots and hashes, the window size it is searched with, its number of fixed
    words and the number of words its templates cover (all, if it has no fixed word)."""
    rows = benchmark.filter(F.col(text_col).isNotNull()).select(F.col(item_col).alias("item_id"), words(F.col(text_col).cast("string")).alias("item_words"))
    rows = stage(rows.filter(F.size("item_words") >= LEAST_WORDS).distinct(), "leak-item-words")
    rows = rows.select("item_id", "item_words", F.transform("item_words", lambda w, i: F.coalesce(slot(F.col("item_words"), w, i), F.lit(0))).alias("slots"),
                       template(F.col("item_words")).alias("hashes"), F.least(F.lit(WINDOW), F.size("item_words")).alias("size"))
    # Places of the windows that are templates; words are counted as those of an occurrence are.
    at = F.filter(F.sequence(F.lit(0), F.size("slots") - F.col("size")), lambda q: F.exists(F.slice("slots", q + 1, F.col("size")), lambda s: s == 0))
    rows = rows.withColumn("at", at)
    covered = F.least(F.array_max("at") - F.array_min("at") + F.col("size"), F.size("at") + F.col("size") - 1)
    return rows.select("*", F.size(F.filter("slots", lambda s: s == 0)).alias("n_fixed"),
                       F.when(F.size("at") > 0, covered).otherwise(F.size("slots")).alias("covered")).drop("at")


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """Windows of the items searched with this size."""
    at = F.inline(windows(F.col("item_words"), F.col("hashes"), size)).alias("q", "window")
    return items.filter(F.col("size") == size).select("item_id", at, F.lit(size).alias("size"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Leaked items: doc_id, item_id, n_windows, n_words (matched words), share (of the item's words), n_slots,
    n_changed (slots with another value) and kind (``exact`` or ``reparameterised``), one row per document and item.

    A null text, of a document or an item, holds nothing. Null document ids are
    searched and reported; rows equal in id and text are reported once. Very
    long texts are searched whole. An empty table on either side gives no rows. Other columns are not read.
    """
    found = _leaked_rows(docs, benchmark, id_col, text_col, item_col, item_text_col)
    if found is None:
        schema = "doc_id long, item_id {}, n_windows long, n_words long, share double, n_slots long, n_changed long, kind string".format(
            benchmark.schema[item_col].dataType.simpleString())
        return docs.sparkSession.createDataFrame([], schema)
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max("n_windows").alias("n_windows"), F.max("n_words").alias("n_words"), F.max(F.col("n_words") / F.col("total")).alias("share"),
                 F.max("n_slots").alias("n_slots"), F.min("n_changed").alias("n_changed"))
            .withColumn("share", F.round(F.least("share", F.lit(1.0)), 6))
            .withColumn("kind", F.when(F.col("n_changed") > 0, "reparameterised").otherwise("exact")))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is leaked, with their columns."""
    found = _leaked_rows(docs, benchmark, id_col, text_col, item_col, item_text_col)
    if found is None:
        return docs
    bad = stage(found.select(F.col("row_key").alias("weekloom_key")).distinct(), "leak-rows")
    keyed = docs.withColumn("weekloom_key", _row_key(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
    return keyed.join(bad, "weekloom_key", "left_anti").select(*docs.columns)


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def _leaked_rows(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str) -> DataFrame | None:
    """One row per leaked item and distinct row of ``docs``; None where no item can be searched."""
    items = stage(items_of(benchmark, item_col, item_text_col), "leak-items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most WINDOW
    wanted = None
    for size in sizes:
        part = item_windows(items, size)
        wanted = part if wanted is None else wanted.unionByName(part)
    if wanted is None:
        return None
    wanted = stage(wanted, "leak-windows")
    few = wanted.count() <= SMALL_WINDOWS

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    row_key = _row_key(F.col("doc_id"), F.col("text")).alias("row_key")
    hashed = (rows.select("doc_id", row_key, words(F.col("text")).alias("doc_words"))
              .select("doc_id", "row_key", "doc_words", template(F.col("doc_words")).alias("hashes")))
    # Windows of all sizes come from one pass; a hash tells its size.
    spans = F.concat(*[windows(F.col("doc_words"), F.col("hashes"), size) for size in sizes])
    each = hashed.select("doc_id", "row_key", F.inline(spans).alias("p", "window"))
    hits = each.join(F.broadcast(wanted) if few else wanted, "window")
    runs = (hits.groupBy("row_key", "doc_id", "item_id", "size", (F.col("p") - F.col("q")).alias("shift"))
            .agg(F.count_distinct("p").alias("n"), F.min("p").alias("first"), F.max("p").alias("last")))
    runs = stage(runs.withColumn("matched", F.least(F.col("last") - F.col("first") + F.col("size"), F.col("n") + F.col("size") - 1)), "leak-runs")

    # Only documents with a match are read again, for the values behind the placeholders.
    matched = (rows.select("doc_id", row_key, "text").join(runs.select("row_key").distinct(), "row_key", "left_semi")
               .select("row_key", words(F.col("text")).alias("doc_words")).dropDuplicates(["row_key"]))
    lined = runs.join(matched, "row_key").join(items.select("item_id", "item_words", "slots", "n_fixed", "covered"), "item_id")
    spots = F.sequence(F.col("first") - F.col("shift"), F.col("last") - F.col("shift") + F.col("size") - 1)
    pairs = F.transform(spots, lambda j: F.struct(
        F.get("slots", j).alias("slot"), F.ltrim(F.get("item_words", j), F.lit(NAME)).alias("a"),
        F.ltrim(F.get("doc_words", j + F.col("shift")), F.lit(NAME)).alias("b")))
    lined = lined.select("row_key", "doc_id", "item_id", "n", "matched", F.size("item_words").alias("total"), "n_fixed",
                         F.least(F.lit(LEAKED_WORDS), F.col("covered")).alias("needed"), pairs.alias("all_pairs"))
    lined = lined.withColumn("pairs", F.filter("all_pairs", lambda x: x["slot"] > 0))
    changed = F.filter("pairs", lambda x: x["a"] != x["b"])
    lined = lined.withColumn("changed", F.size(changed)).withColumn("names", F.size(F.filter(changed, lambda x: x["slot"] == PERSON)))
    one_value = F.size(F.array_distinct(F.transform("pairs", lambda x: F.struct(x["slot"], x["a"])))) == F.size(F.array_distinct("pairs"))
    same = F.size(F.filter("all_pairs", lambda x: (x["slot"] == 0) & (x["a"] == x["b"])))
    telling = (same >= F.greatest(F.lit(1), F.least(F.lit(FIXED_WORDS), F.col("n_fixed")))) & (F.size("all_pairs") - F.col("names") >= FIXED_WORDS)
    # Numbers or names alone count as they are written, and not piece by piece.
    kept = lined.filter(one_value & (telling | ((F.col("changed") == 0) & (F.col("matched") >= F.least(F.lit(LEAKED_WORDS), F.col("total"))))))
    per_item = kept.groupBy("row_key", "doc_id", "item_id").agg(
        F.sum("n").alias("n_windows"), F.sum("matched").cast("long").alias("n_words"), F.max("total").alias("total"), F.max("needed").alias("needed"),
        F.sum(F.size("pairs")).cast("long").alias("n_slots"), F.sum("changed").cast("long").alias("n_changed"))
    return per_item.filter(F.col("n_words") >= F.col("needed")).drop("needed")
