"""Personal data in whole texts, with DataFrame functions only.

Regular expressions propose spans, checksums and digit counts confirm them,
and words near a span move its score. A pattern's matches come from
``regexp_extract_all`` and the pieces between them from ``split``; running
sums of their lengths give every match its place in code points. The patterns
are the plain ones below with possessive repeats and a look-behind at the start
of a run, which match the same spans but never rescan or nest on long runs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code points on either side of a span in which context words count.
CONTEXT = 40


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str     # as matched
    needs: str       # a text without this expression holds no match
    score: float     # of a confirmed match
    context: str     # words that raise the score
    against: str     # words that lower it
    least: float     # spans below this score are dropped


# Base kinds first, in the order in which spans at one place are listed.
EMAIL = Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
             r"e-?mail|contact|write|correo|courriel", r"example|noreply", 0.0)
IP = Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6,
          r"\bip\b|address|server|host|login|adresse", r"version|release|section", 0.0)
CARD = Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9]", 0.7,
            r"card|visa|master|credit|debit|amex|karte|carte|tarjeta", r"order|tracking|serial|isbn", 0.0)
PHONE = Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7,
             r"phone|tel|call|mobile|fax|whatsapp|handy|telefono", r"offset|index", 0.0)
BASE = (EMAIL, IP, CARD, PHONE)
# Added kinds: an account number confirmed by its remainder modulo 97, and a
# number in the form of a social security number, kept only near its words.
IBAN = Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}", 0.9,
            r"iban|account|bank|konto|cuenta|compte", r"order|serial", 0.5)
SSN = Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]-[0-9]", 0.4,
           r"ssn|social security|taxpayer|identification", r"order|part|serial|tracking", 0.5)
KINDS = (*BASE, IBAN, SSN)
BONUS = 0.2
PREFIX = "weekloom_"  # of the columns added to whole rows, so that no column of the caller is hidden


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether the digits pass the Luhn checksum: from the right, every second one doubled."""
    values = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether an account number leaves 1 modulo 97, its first four characters moved to the end and letters counted from 10."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def step(acc: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(F.ascii(c) >= 65, (acc * 100 + letter) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97)
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def confirmed(kind: Kind, match: Column) -> Column:
    if kind is IP:
        # A part of more than three digits may still be small: 0001 is 1.
        parts = F.split(match, r"\.")
        return F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
            parts, lambda p: F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255)
    if kind is CARD:
        number = digits(match)
        return F.when(F.length(number).between(12, 19), luhn(number)).otherwise(False)
    if kind is PHONE:
        return F.length(digits(match)).between(9, 15)
    if kind is IBAN:
        return mod97(match)
    return F.lit(True)


def score(kind: Kind, text: Column, start: Column, end: Column) -> Column:
    near = F.lower(F.concat(F.substring(text, F.greatest(start - CONTEXT, F.lit(0)) + 1, F.least(start, F.lit(CONTEXT))),
                            F.lit(" "), F.substring(text, end + 1, F.lit(CONTEXT))))
    moved = F.lit(kind.score) + F.when(near.rlike(kind.context), F.lit(BONUS)).otherwise(0.0) - F.when(
        near.rlike(kind.against), F.lit(BONUS)).otherwise(0.0)
    return F.round(F.greatest(F.least(moved, F.lit(1.0)), F.lit(0.0)), 3)


SPAN = "struct<start:int,rank:int,kind:string,end:int,score:double>"


def matched(rows: DataFrame, text: str) -> DataFrame:
    """Add, under PREFIX, m_<kind>, the leftmost matches that do not overlap, and g_<kind>, the pieces of text before each.

    They are columns, not parts of a longer expression, so that each pattern
    runs over a text once for either.
    """
    t, none = F.col(text), F.array().cast("array<string>")
    rows = rows.select("*", *[F.when(t.rlike(k.needs), F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))).otherwise(none).alias(f"{PREFIX}m_{k.name}")
                              for k in KINDS])
    return rows.select("*", *[F.when(F.size(f"{PREFIX}m_{k.name}") > 0, F.slice(F.split(t, k.pattern, -1), 1, F.size(f"{PREFIX}m_{k.name}"))).otherwise(none)
                              .alias(f"{PREFIX}g_{k.name}") for k in KINDS])


def spans(kind: Kind, text: Column) -> Column:
    """Confirmed spans of one kind, in order, from the columns of ``matched``."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind.name).alias("kind"),
                        end.alias("end"), score(kind, text, start, end).alias("score")).cast(SPAN)
        return F.struct(end.alias("at"), F.when(confirmed(kind, pair["match"]), F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    pairs = F.zip_with(f"{PREFIX}g_{kind.name}", f"{PREFIX}m_{kind.name}", lambda g, m: F.struct(g.alias("gap"), m.alias("match")))
    found = F.filter(F.aggregate(pairs, zero, step)["out"], lambda s: s["score"] >= kind.least)
    return F.when(F.size(f"{PREFIX}m_{kind.name}") > 0, found).otherwise(F.array().cast(f"array<{SPAN}>"))


def listed(all_spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined, by start and then kind."""
    return F.array_join(F.transform(F.array_sort(all_spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of each kind and in all, per row.

    A null text is empty and has none. Null and repeated ids stay, each row for
    itself; an empty table gives no rows. Very long texts are searched whole:
    every pattern passes over its text once. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    each = matched(rows, "text").select("doc_id", *[spans(k, F.col("text")).alias(k.name) for k in KINDS])
    return each.select("doc_id", *[k.name for k in KINDS], F.concat(*[F.col(k.name) for k in BASE]).alias("base"),
                       F.concat(*[F.col(k.name) for k in KINDS]).alias("all_spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with every span of at least this score replaced by <kind>; where spans overlap the first stays whole."""
    own = f"{PREFIX}text"
    text = F.col(own)
    rows = matched(docs.withColumn(own, F.coalesce(F.col(text_col).cast("string"), F.lit(""))), own)
    every = F.concat(*[spans(k, text) for k in KINDS])
    rows = rows.withColumn(f"{PREFIX}spans", F.array_sort(F.filter(every, lambda s: s["score"] >= least)))
    found = F.col(f"{PREFIX}spans")
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        put = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["kind"], F.lit(">"))
        over = s["start"] < acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(over, acc["out"]).otherwise(put).alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    done = F.aggregate(found, zero, step, finish)
    new = F.when(F.col(text_col).isNotNull(), F.when(F.size(found) > 0, done).otherwise(text))
    return rows.select(*[new.alias(c) if c == text_col else F.col(c) for c in docs.columns])
