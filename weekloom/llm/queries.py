"""The text operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.llm import (
    binary_out, bpe, decontaminate, license_scan, lm_backoff, near_dup, packing, periodic_runs, pii, prefix_trie, quality_pu, quality_rules, toxicity,
)
from weekloom.llm.common import documents, stage, staging_root, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


@query("op6_packing")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(documents(spark, sf_dir))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op9_binary_output")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = binary_out.write_tokens(documents(spark, sf_dir), f"{staging_root(spark)}/weekloom")
    rows = binary_out.read_tokens(spark, folder)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


_GRID = ", ".join(map(str, quality_rules.GRID))
_RULES = ", ".join(f"'{r}'" for r in quality_rules.RULES)
RULES_SQL = rf"""WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (
  SELECT r, unnest(range(i, i + 8)) AS p FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1) GROUP BY r),
c AS (
  SELECT d.r, doc_id, stratum, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_runs,
         len(list_filter(string_split(t, ''), lambda x: x <> lower(x))) AS n_upper
  FROM d LEFT JOIN rep ON rep.r = d.r),
f AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         [coalesce(n_symbols / nullif(word_chars, 0), 0), coalesce(n_dup_lines / nullif(n_lines, 0), 0), coalesce(n_repeat_words / nullif(n_words, 0), 0),
          coalesce(n_runs / nullif(n_words, 0), 0), coalesce(n_upper / nullif(word_chars, 0), 0)] AS shares FROM c),
lab AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
cal AS (SELECT stratum, quality, shares FROM f JOIN lab USING (doc_id) WHERE quality IS NOT NULL AND NOT base_failed),
n AS (SELECT stratum, count(*) FILTER (quality = 1) AS n_good FROM cal GROUP BY 1),
g AS (
  SELECT stratum, j, k, n_good, count(*) FILTER (quality = 1 AND shares[j] > [{_GRID}][k]) AS good, count(*) FILTER (quality = 0 AND shares[j] > [{_GRID}][k]) AS bad
  FROM cal JOIN n USING (stratum), unnest(range(1, {len(quality_rules.RULES) + 1})) AS a(j), unnest(range(1, {len(quality_rules.GRID) + 1})) AS b(k) GROUP BY ALL),
p AS (
  SELECT *, CASE WHEN n_good = 0 OR good >= n_good THEN 1.0 ELSE list_sum(list_transform(range(0, good + 1), lambda i: exp(
    lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({quality_rules.ALPHA} / 5) + (n_good - i) * ln(1 - {quality_rules.ALPHA} / 5)))) END AS tail FROM g),
v AS (SELECT *, max((tail > {quality_rules.DELTA} / (5 * (SELECT count(*) FROM n)))::INT) OVER (PARTITION BY stratum, j ORDER BY k) AS failed FROM p),
u AS (SELECT stratum, j, arg_max([{_GRID}][k], (bad - {quality_rules.COST} * good) * 1000 - k) AS cut FROM v WHERE failed = 0 AND bad - {quality_rules.COST} * good > 0 GROUP BY 1, 2),
cuts AS (SELECT stratum, [{", ".join(f"coalesce(max(cut) FILTER (j = {j + 1}), 2.0)" for j in range(len(quality_rules.RULES)))}] AS cut FROM u GROUP BY 1),
z AS (
  SELECT f.*, list_concat(CASE WHEN base_failed THEN ['base'] ELSE [] END,
    list_filter([{_RULES}], lambda x: shares[list_position([{_RULES}], x)] > coalesce(cut[list_position([{_RULES}], x)], 2.0))) AS reasons
  FROM f LEFT JOIN cuts USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, len(reasons) = 0 AS kept, stratum,
       array_to_string(reasons, ',') AS reasons FROM z"""


@query("op10_quality_rules", RULES_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = quality_rules.judge(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return verdict.withColumn("reasons", F.array_join("reasons", ","))


def _pii_kind(kind: str, rank: int, pattern: str, check: str) -> str:
    return f"""SELECT r, '{kind}' AS kind, {rank} AS rank, a, a + length(x) AS z, x FROM (
      SELECT r, m[i] AS x, coalesce(list_sum(list_transform(g[1:i], lambda v: length(v))), 0) + coalesce(list_sum(list_transform(m[1:i - 1], lambda v: length(v))), 0) AS a, t
      FROM (SELECT r, t, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
        SELECT r, t, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM d))) WHERE {check}"""


_DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
_LUHN = f"""length({_DIGITS}) BETWEEN 12 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k: CASE
  WHEN k % 2 = 1 THEN substr({_DIGITS}, -k, 1)::INT ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr({_DIGITS}, -k, 1)::INT + 1] END)) % 10 = 0"""
_MOVED = "(substr(replace(x, ' ', ''), 5) || left(replace(x, ' ', ''), 4))"
_MOD97 = f"""list_reduce(list_prepend(0, list_transform(string_split({_MOVED}, ''), lambda c: CASE WHEN ascii(c) >= 65 THEN 1000 + ascii(c) - 55 ELSE ascii(c) - 48 END)),
  lambda acc, v: CASE WHEN v >= 1000 THEN (acc * 100 + v - 1000) % 97 ELSE (acc * 10 + v) % 97 END) = 1"""
_NEAR = "lower(substr(t, greatest(a - 40, 0)::BIGINT + 1, least(a, 40)::BIGINT) || ' ' || substr(t, (a + length(x))::BIGINT + 1, 40))"
PII_SQL = """WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents), s AS (
""" + "\nUNION ALL\n".join([
    _pii_kind("email", 0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
    _pii_kind("ip", 1, r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "list_max(list_transform(string_split(x, '.'), lambda p: try_cast(p AS DOUBLE))) <= 255"),
    _pii_kind("card", 2, r"[0-9](?:[ -]?[0-9])+", _LUHN),
    _pii_kind("phone", 3, r"\+[0-9][ ().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
    _pii_kind("iban", 4, r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b", _MOD97),
    _pii_kind("ssn", 5, r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", f"""regexp_matches({_NEAR}, 'ssn|social security|taxpayer|identification')
      AND NOT regexp_matches({_NEAR}, 'order|part|serial|tracking')""")]) + """)
SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card,
       count(*) FILTER (kind = 'phone') AS n_phone,
       sha256(coalesce(string_agg(concat_ws(':', kind, a::BIGINT, z::BIGINT), ',' ORDER BY a, rank) FILTER (rank < 4), '')) AS base_sha256,
       coalesce(string_agg(concat_ws(':', kind, a::BIGINT, z::BIGINT), ',' ORDER BY a, rank) FILTER (kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id"""


@query("op5_pii", PII_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir))
    return found.select(
        "doc_id", *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in pii.BASE],
        F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("all_spans")).alias("spans"))


@query("op2_quality_pu")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_pu.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query("op8_decontamination")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query("op7_near_duplicates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.row_classes(documents(spark, sf_dir))


LM_SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (
  SELECT r, i, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS before
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM t)),
n AS (SELECT count(*) AS n FROM p),
c1 AS (SELECT word, count(*) AS c FROM p GROUP BY word HAVING count(*) >= 2),
c2 AS (SELECT before, word, count(*) AS c FROM p WHERE before IS NOT NULL GROUP BY ALL HAVING count(*) >= 2),
s AS (
  SELECT r, CASE WHEN c2.c IS NOT NULL THEN ln(c2.c / h.c)
                 ELSE ln(coalesce(c1.c, 1) / (SELECT n FROM n)) + CASE WHEN p.before IS NULL THEN 0 ELSE ln(0.4) END END AS x,
         (p.before IS NOT NULL AND c2.c IS NULL)::INT AS down
  FROM p LEFT JOIN c1 ON c1.word = p.word LEFT JOIN c2 ON c2.before = p.before AND c2.word = p.word
         LEFT JOIN c1 h ON h.word = p.before)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, round(coalesce(sum(s.x), 0), 4) AS log_score,
       CASE WHEN len(t.w) > 0 THEN round(coalesce(sum(s.x), 0) / len(t.w), 6) END AS mean_log,
       coalesce(sum(s.down), 0)::BIGINT AS n_backed_off
FROM t LEFT JOIN s ON s.r = t.r GROUP BY t.r, t.doc_id, t.w
"""


@query("op3_lm_backoff", LM_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = lm_backoff.score(documents(spark, sf_dir))
    return scores.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log", 6).alias("mean_log"), "n_backed_off")


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """Numbered turns of conversations whose first turns come from the first of their five neighbours.

    Conversation c gets the first h turns of c - c % 5 (crc32 of c % 9) and
    keeps its own turns after its first h. A group is at most five rows.
    """
    first = F.col("conv_id") - F.col("conv_id") % 5
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    groups = sizes.groupBy(first.alias("first")).agg(F.collect_list(F.struct("conv_id", "n")).alias("group"))

    def h(c):
        return F.crc32(c.cast("string").cast("binary")) % 9

    rows = turns.withColumn("first", first).join(groups, "first")
    base = F.coalesce(F.filter("group", lambda x: x["conv_id"] == F.col("first"))[0]["n"], F.lit(0))
    own = h(F.col("conv_id"))
    kept = F.when(F.col("position") > own, F.array(F.struct(
        F.col("conv_id").alias("conv_id"), (F.least(own, base) + F.col("position") - own).cast("long").alias("position")))).otherwise(F.array())
    lent = F.when(F.col("conv_id") == F.col("first"), F.transform(
        F.filter("group", lambda x: F.col("position") <= h(x["conv_id"])),
        lambda x: F.struct(x["conv_id"].alias("conv_id"), F.col("position").alias("position")))).otherwise(F.array())
    return rows.select(F.inline(F.concat(kept, lent)), "key", "n_bytes")


@query("op11_prefix_trie")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = stage(prefix_trie.numbered(prefix_trie.turn_keys(table(spark, sf_dir, "conversations"))), "turns")
    return prefix_trie.nodes(rebuilt_turns(turns), turns.select("conv_id").distinct())


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents of which every tenth, by crc32 of its id, repeats a stretch of its words to its end."""
    code = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n = F.floor(code / 10), F.size("_w")
    tenth = docs.select("doc_id", "text", F.when(code % 10 == 0, words).alias("_w"), g.alias("_g"))
    start = tenth.withColumn("_a", F.when(n > 0, (F.col("_g") % n).cast("int")))
    period = start.withColumn("_p", F.when(n > 0, (1 + F.floor((n - F.col("_a")) / (3 + F.col("_g") % 8))).cast("int")))
    repeated = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(
        F.col("_w"), F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))))
    return period.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.scan(with_periods(documents(spark, sf_dir)))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[best[c].alias(c) for c in ("start", "length", "period")],
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query("op13_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = bpe.decode(bpe.encode(documents(spark, sf_dir)))
    return read.select("doc_id", "n_tokens", F.sha2(F.col("ids_text").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
