"""Quality rules and personal data against plain Python."""

import collections
import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from weekloom.llm import pii, quality_rules

LONG = " ".join(f"w{k % 50}" for k in range(5000))
TEXTS = ["one two three " * 10, "", None, "   \n\t ", "a\nb\na\n\n \n \na", LONG, "#*$ % x " * 9, " ".join(f"u{k}" for k in range(40)),
         "hard space is part of words " * 5, "\x1c\x1f " * 30, " ".join("abcdefgh") + " x " + " ".join("abcdefgh") + " y" * 3]


def counted(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    c = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    marked = {j for i in range(len(w) - 7) if c[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(marked), len(w) < 20 or 100 * len(marked) > 30 * len(w)


def test_counts_match_a_plain_version(spark):
    docs = spark.createDataFrame([(k, t, None if k == 4 else "en", 0) for k, t in enumerate(TEXTS)] + [(None, "x", "en", 1), (0, "y", "en", 1)],
                                 "doc_id long, text string, lang string, stratum int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality_rules.judge(docs, labels).collect()
    assert len(got) == len(TEXTS) + 2
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"]].append((r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]))
    for k, t in enumerate(TEXTS):
        assert counted(t) in by[k]
    assert all(r["kept"] != r["base_failed"] for r in got)
    assert quality_rules.keep(docs, labels).columns == docs.columns
    assert quality_rules.keep(docs, labels).count() == sum(r["kept"] for r in got)
    assert quality_rules.judge(docs.limit(0), labels).count() == 0


def test_binomial_tail_is_exact():
    for k, n, p in [(0, 10, 0.1), (3, 20, 0.2), (5, 5, 0.5), (2, 400, 0.01)]:
        want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(min(k, n) + 1))
        assert quality_rules.binomial_tail(k, n, p) == pytest.approx(want, rel=1e-9)


def test_certified_stops_at_the_first_failure():
    n = len(quality_rules.GRID)
    # No good document is rejected anywhere: the cutoff with most bad ones is used.
    assert quality_rules.certified(100_000, [0] * n, list(range(1, n + 1)), 0.001, 0.004) == quality_rules.GRID[-1]
    # Too few labels certify nothing.
    assert quality_rules.certified(50, [0] * n, [9] * n, 0.001, 0.004) == 2.0
    # Beyond a cutoff that fails, none is used although it would pass.
    good = [0, 5000, *[0] * (n - 2)]
    assert quality_rules.certified(100_000, good, [1] * n, 0.001, 0.004) == quality_rules.GRID[0]


def test_cutoffs_reject_bad_and_bound_the_good(spark):
    rows, labels = [], []
    for k in range(6000):
        bad = k % 4 == 0
        text = " ".join(f"w{k}x{j}" + ("$$$" if bad and j % 2 else "") for j in range(30))
        rows.append((k, text, "en"))
        labels.append((k, 0 if bad else 1))
    rows.append((9999, "no label and no stratum " + " ".join(f"q{j}" for j in range(30)), None))
    got = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string"),
                              spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id long, quality int")).collect()
    kept = {r["doc_id"] for r in got if r["kept"]}
    assert kept == {k for k in range(6000) if k % 4} | {9999}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


PRIVATE = ["a@b.c_d@e.f", "x@y.z.w..q@r.s", "1.2.3.4.5.6.7.8 0001.2.3.255 256.1.1.1 1.2.3.4000 00000000000000000001.2.3.4", "4111 1111 1111 1111 4111-1111-1111-1111",
           "card 4111 1111 1111 1111, x", "+1 (555) 123-4567 +49 30 1234567..", "é@ä.b ü1.2.3.4 😀 a@b.co 😀 4111111111111111", "9" * 50_000,
           "a" * 30_000 + " ." + "a@" * 9_000, None, "", " +1" + " ." * 9_000, "@a.b +1 2 3 4 5 6 7 8 9(", "user@host.com-x.y@z.w a.b@c-d.e-f", "1.2.3.4@5.6.7.8"]


def test_base_spans_match_plain_expressions(spark):
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(PRIVATE)] + [(None, "a@b.c", 2), (0, "z@z.zz", 3)], "doc_id long, text string, base int")
    got = pii.find(docs).select("doc_id", pii.listed(F.col("base")).alias("b"), F.size("email").alias("n")).collect()
    assert len(got) == len(PRIVATE) + 2
    for k, t in enumerate(PRIVATE):
        assert base_spans(t or "") in [r["b"] for r in got if r["doc_id"] == k], k
    assert pii.find(docs.limit(0)).count() == 0
    assert hashlib.sha256(b"").hexdigest() == docs.limit(1).select(F.sha2(pii.listed(F.array().cast(f"array<{pii.SPAN}>")).cast("binary"), 256)).first()[0]


def test_added_spans_need_checksum_or_context(spark):
    texts = ["GB82 WEST 1234 5698 7654 32", "GB83WEST12345698765432", "ssn 123-45-6789", "123-45-6789", "order 123-45-6789", "bank DE89370400440532013000.", "DE89370400440532013000 Bank"]
    got = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", pii.listed(F.col("all_spans")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in got} == {0: "iban:0:27", 1: "", 2: "ssn:4:15", 3: "", 4: "", 5: "iban:5:27", 6: "iban:0:22"}


def test_redaction_keeps_columns_and_nulls(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or +1 555 123 4567 now", 7), (2, None, 7), (3, "", 7), (None, "nothing here", 7)], "doc_id long, text string, m_email int")
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs.withColumnRenamed("m_email", "kept")).collect()}
    assert got == {1: "mail <email> or <phone> now", 2: None, 3: "", None: "nothing here"}
    assert pii.redact(docs).columns == docs.columns
