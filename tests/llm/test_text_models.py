"""Classifiers on held-out rows, language-model scores and licence spans against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from weekloom.llm import license_scan, lm_backoff, quality_pu, toxicity


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeghilmnorst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for k in range(1600):
        bad, toxic = k % 5 == 0, k % 7 == 0
        text = prose(rng, rng.randint(30, 120), words)
        if bad:
            text = " | ".join(text.split()) if k % 2 else text.upper().replace(" ", "!! ")
        if toxic:
            text += " " + " ".join("grawlix" + rng.choice(["", "ed", "er", "ing"]) for _ in range(3))
        rows.append((k, text, "en", 1.0))
        if k % 4 != 3:
            labels.append((k, 0 if bad else 1, int(toxic)))
    rows += [(5000, None, None, None), (5001, "", "en", 0.0), (None, "no id here at all", "en", 0.0), (7, "repeated id", "en", 0.0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, score double"),
            spark.createDataFrame(labels + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int"))


def test_pu_scores_on_held_out_rows(spark, corpus):
    docs, labels = corpus
    got = quality_pu.score(docs, labels).collect()
    assert len(got) == 1604 and all(0 <= r["score"] <= 1 for r in got)
    test = [r for r in got if r["held_out"] and r["doc_id"] < 1600 and r["doc_id"] != 7]
    right = [r["predicted"] == (r["doc_id"] % 5 != 0) for r in test]
    assert len(test) > 200 and sum(right) / len(right) > 0.9
    assert abs(got[0]["prior"] - 0.8) < 0.1


def test_pu_learns_nothing_from_held_out_labels(spark, corpus):
    from pyspark.sql import functions as F

    from weekloom.llm.common import held_out

    docs, labels = corpus
    other = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    key = lambda rows: sorted((r["doc_id"] or -1, r["score"]) for r in rows)
    assert key(quality_pu.score(docs, labels).collect()) == key(quality_pu.score(docs, other).collect())


def test_models_without_labels_or_rows(spark, corpus):
    docs, labels = corpus
    assert {r["score"] for r in quality_pu.score(docs, labels.limit(0)).collect()} == {0.5}
    assert {r["toxic"] for r in toxicity.score(docs, labels.limit(0)).collect()} == {0}
    assert quality_pu.score(docs.limit(0), labels).count() == 0
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_non_negative_risk_recovers_the_boundary():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1.5, 1, (3000, 2)), rng.normal(-1.5, 1, (3000, 2))
    unlabelled = np.concatenate([good[1000:], bad[:1000]])
    prior = quality_pu.class_prior(good[:1000], unlabelled)
    assert abs(prior - 2 / 3) < 0.12
    model = quality_pu.fit(good[:1000], unlabelled, prior)
    assert (model.probability(good[1000:]) > 0.5).mean() > 0.9 and (model.probability(bad) < 0.5).mean() > 0.9


def test_chain_finds_toxic_rows_and_leaves_clean_ones(spark, corpus):
    docs, labels = corpus
    got = toxicity.score(docs, labels).collect()
    assert len(got) == 1604
    unseen = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 1600 and r["doc_id"] % 4 == 3 and r["doc_id"] != 7]
    assert [r["toxic"] for r in unseen] == [int(r["doc_id"] % 7 == 0) for r in unseen]
    assert {r["toxic"] for r in got if r["doc_id"] in (5000, 5001)} == {0}


def test_later_models_see_earlier_probabilities():
    rng = np.random.default_rng(2)
    first = rng.random(800) < 0.5
    slots = [np.array([1 if f else 2, 10 + int(rng.integers(50))], np.int32) for f in first]
    chain = toxicity.fit(slots, np.column_stack([first, first]).astype(int), ("a", "b"))
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    assert chain.weights[1][-2] > 0
    both = chain.score(slots)
    assert ((both > 0.5) == first[:, None]).all()


def brute_backoff(texts, order, alpha, least):
    docs = [re.findall(r"[^ \t-\r]+", t or "") for t in texts]
    counts = Counter(tuple(d[i:i + n]) for d in docs for n in range(1, order + 1) for i in range(len(d) - n + 1))
    counts = {g: c for g, c in counts.items() if c >= least}
    total = sum(map(len, docs))

    def s(gram):
        if len(gram) == 1:
            return max(counts.get(gram, 1), 1) / total
        return counts[gram] / counts[gram[:-1]] if gram in counts else alpha * s(gram[1:])
    return [sum(math.log(s(tuple(d[max(0, i - order + 1):i + 1]))) for i in range(len(d))) for d in docs]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_matches_plain_counts(spark, monkeypatch, order):
    rng = random.Random(order)
    texts = [" ".join(rng.choice("a b c d e f g h".split()) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += [None, "", " \n ", "a", "rare words only", "a b c " * 400]
    docs = spark.createDataFrame([(k, t, "x") for k, t in enumerate(texts)] + [(None, "a b", "x"), (3, "b a", "x")], "doc_id long, text string, block string")
    monkeypatch.setattr(lm_backoff, "RANGE_WORDS", 100)
    got = lm_backoff.score(docs.repartition(3), order=order).collect()
    want = brute_backoff([*texts, "a b", "b a"], order, lm_backoff.ALPHA, lm_backoff.MIN_COUNT)
    assert sorted(round(r["log_score"], 6) for r in got) == sorted(round(w, 6) for w in want)
    by = {r["doc_id"]: r for r in got if r["doc_id"] not in (3, None)}
    assert all(by[k]["log_score"] == pytest.approx(want[k]) for k in by)
    assert by[60]["n_words"] == 0 and by[60]["mean_log"] is None
    assert lm_backoff.score(docs.limit(0)).count() == 0


def test_licences_are_found_with_their_spans(spark):
    mit, line = license_scan.TEMPLATES["mit"], license_scan.TEMPLATES["mit-line"]
    changed = mit.replace("to deal in", "to freely deal within").replace("sublicense, ", "")
    texts = ["İntro words. " + line + " end", "x " + changed + " y", None, "", "released under a licence", "prose of the and to in any " * 300, line * 3,
             mit[:len(mit) // 2] + " unrelated"]
    docs = spark.createDataFrame([*enumerate(texts), (None, line)], "doc_id long, text string")
    got = {}
    for r in license_scan.scan(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == {0, 1, 6, 7, None}
    r = got[0][0]
    assert texts[0][r["start"]:r["end"]] == line.rstrip(".") and r["coverage"] == 1.0
    r = next(x for x in got[1] if x["license"] == "mit")
    assert texts[1][r["start"]:r["end"]] == changed.rstrip(".") and 0.9 < r["coverage"] < 1
    assert len([x for x in got[6] if x["license"] == "mit-line"]) == 3
    assert 0.4 < next(x for x in got[7] if x["license"] == "mit")["coverage"] < 0.75
    assert license_scan.scan(docs.limit(0)).count() == 0


def test_words_before_a_licence_that_lower_case_would_cut(spark):
    line = license_scan.TEMPLATES["mit-line"].rstrip(".")
    text = "\u0130stanbul \u0130zmir " * 20 + line
    found = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(r["license"], r["coverage"], text[r["start"]:r["end"]]) for r in found] == [("mit-line", 1.0, line)]


def test_alignment_counts_words_in_order():
    assert license_scan.align("a b c d e".split(), "x a b q c e y".split(), 1, 4) == (4, 0, 5, 1, 6)


def plain_alignment(template, words, diagonal, band):
    """Cell by cell, the way back by the first of pair, gap in the region, gap in the template."""
    best, end, score, way = 0, (0, 0), {}, {}
    for i in range(1, len(template) + 1):
        for j in range(1, len(words) + 1):
            if abs(j - i - diagonal) <= band:
                pair = license_scan.MATCH if template[i - 1] == words[j - 1] else license_scan.MISMATCH
                steps = (0, score.get((i - 1, j - 1), 0) + pair, score.get((i - 1, j), 0) + license_scan.GAP, score.get((i, j - 1), 0) + license_scan.GAP)
                if max(steps) > 0:
                    score[i, j], way[i, j] = max(steps), steps.index(max(steps))
                    if max(steps) > best:
                        best, end = max(steps), (i, j)
    (i, j), matched = end, 0
    while (i, j) in score:
        step = way[i, j]
        matched += step == 1 and template[i - 1] == words[j - 1]
        i, j = i - (step != 3), j - (step != 2)
    return matched, i, end[0], j, end[1]


def test_alignment_equals_cell_by_cell():
    rng = random.Random(9)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(1, 14))] for _ in range(2))
        args = (a, b, rng.randint(-6, 6), rng.randint(0, 9))
        assert license_scan.align(*args) == plain_alignment(*args)


def edited(rng, words, share):
    out = []
    for w in words:
        out += [w] if rng.random() > share else rng.choice([[], ["changed"], [w, "added"]])
    return out


def test_scan_equals_unbanded_alignment_of_all_templates(spark):
    rng = random.Random(21)
    prose_words = [f"filler{k}" for k in range(200)]
    texts = []
    for name, template in license_scan.TEMPLATES.items():
        for share in (0, 0.03):
            body = edited(rng, template.split(), share)
            texts.append(" ".join([*rng.choices(prose_words, k=rng.randint(0, 30)), *body, *rng.choices(prose_words, k=5)]))
    found = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {(r["doc_id"], r["license"]): r for r in sorted(found, key=lambda r: r["n_words"])}
    for a in found:
        same = [b for b in found if (a["doc_id"], a["license"]) == (b["doc_id"], b["license"]) and b["start"] < a["end"] and a["start"] < b["end"]]
        assert same == [a]
    for k, name in enumerate(n for n in license_scan.TEMPLATES for _ in range(2)):
        template, words = license_scan.words_of(license_scan.TEMPLATES[name]), license_scan.words_of(texts[k])
        matched, t0, t1, _, _ = plain_alignment(template, words, 0, len(template) + len(words))
        if matched / len(template) < license_scan.MIN_SHARE and matched < license_scan.MIN_WORDS:
            assert (k, name) not in got
        else:
            r = got[k, name]
            assert (r["n_words"], r["template_start"], r["template_end"]) == (matched, t0, t1)


def test_ranges_of_hashes():
    rng = np.random.default_rng(3)
    codes = np.unique(np.append(rng.integers(0, 1 << 63, 500, np.uint64) * np.uint64(2), np.array([0, (1 << 64) - 1], np.uint64)))
    for ranges in (1, 2, 3, 7, 64, 100_000):
        used, at = lm_backoff.cuts(codes, ranges)
        width = (1 << 64) // ranges + 1
        want = [min(int(c) // width, ranges - 1) for c in codes]
        assert [k for k, a, z in zip(used, at, at[1:]) for _ in range(a, z)] == want
    assert lm_backoff.cuts(codes[:0], 5) == ([], [0])
