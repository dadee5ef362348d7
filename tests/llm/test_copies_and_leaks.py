"""Near copies and benchmark leaks against plain Python, and the pipeline against its stages' plain versions."""

import random
from collections import Counter

import pyarrow as pa
import pytest

from weekloom.llm import decontaminate, near_dup


def plain_sets(text):
    w = (text or "").lower().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def plain_similarity(a, b):
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys())
    return total


def test_probability_jaccard_matches_its_definition():
    rng = random.Random(3)
    for _ in range(40):
        a, b = (" ".join(rng.choice("ab") for _ in range(rng.randint(1, 30))) for _ in range(2))
        want = plain_similarity(plain_sets(a), plain_sets(b))
        assert near_dup.probability_jaccard(near_dup.weighted(a), near_dup.weighted(b)) == pytest.approx(want)


def test_sketch_agreement_estimates_the_similarity():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(300)]
    texts = [" ".join(w if rng.random() > p else rng.choice(words) for w in base) for p in (0, 0.01, 0.03, 0.08)]
    sets = [near_dup.weighted(t) for t in texts]
    held = near_dup.sketch_batch(sets)
    for k in range(1, 4):
        assert abs((held[0] == held[k]).mean() - near_dup.probability_jaccard(sets[0], sets[k])) < 0.12
    # A sketch does not depend on the texts it is made with.
    assert (near_dup.sketch_batch(sets[2:3])[0] == held[2]).all()


def test_long_texts_are_sketched_a_few_at_a_time(monkeypatch):
    """What is sketched at once is bounded in characters, and known words are let go between blocks."""
    class Direct:
        def mapInArrow(self, run, schema):
            return run

    rng, at_once, known = random.Random(9), [], []
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (3000, 10, 2000, 2500, 5, 1, 4000, 700)]
    part = pa.RecordBatch.from_arrays([pa.array(range(8), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    whole = next(near_dup.sketches(Direct())(iter([part]))).to_pylist()
    sketch, shingles = near_dup.sketch_batch, near_dup.shingles
    monkeypatch.setattr(near_dup, "SKETCH_CHARS", 20_000)
    monkeypatch.setattr(near_dup, "KNOWN_WORDS", 1000)
    monkeypatch.setattr(near_dup, "sketch_batch", lambda sets: at_once.append(sum(len(x[0]) for x in sets)) or sketch(sets))
    monkeypatch.setattr(near_dup, "shingles", lambda text, codes: known.append(len(codes)) or shingles(text, codes))
    cut = [r for b in near_dup.sketches(Direct())(iter([part])) for r in b.to_pylist()]
    assert cut == whole and len(at_once) > 3 and max(at_once) <= 4000 and max(known) <= 4000


def plain_classes(rows):
    sets = {k: plain_sets(t) for k, t in rows}
    up = {k: k for k in sets}

    def root(a):
        while up[a] != a:
            a = up[a]
        return a
    names = sorted(sets)
    for i, a in enumerate(names):
        for b in names[:i]:
            if sets[a] and sets[b] and root(a) != root(b) and plain_similarity(sets[a], sets[b]) >= 0.8:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {k: root(k) for k in names}


def test_classes_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    rng = random.Random(8)
    words = [f"w{k}" for k in range(300)]
    rows = []
    for g in range(6):
        base = [rng.choice(words) for _ in range(60)]
        for _ in range(14):
            # Few changed words: similarities on both sides of 0.8, so chains of links matter.
            rows.append(" ".join(w if rng.random() > 0.018 else rng.choice(words) for w in base))
    rows += ["short one", "Short  ONE", "a b c d", None, "", "  ", " ".join(words * 20), " ".join(words * 20) + " tail"]
    table = list(enumerate(rows))
    docs = spark.createDataFrame([(k, t, 0) for k, t in table], "doc_id long, text string, bands int")
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in near_dup.row_classes(docs).collect()}
    want = plain_classes(table)
    assert got == {k: (c, k == c) for k, c in want.items()}
    assert len(set(want.values())) < len(want) - 20
    left = near_dup.keep_rows(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(set(want.values()))


def test_a_group_of_many_small_classes_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rng = random.Random(12)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(90)]
    # One passage in all texts puts them into common bands; most are not alike.
    table = [(k, " ".join(base[:70] + [rng.choice(words) for _ in range(rng.choice([3, 8, 14, 24]))])) for k in range(70)]
    got = {r["doc_id"]: r["class_id"] for r in near_dup.row_classes(spark.createDataFrame(table, "doc_id long, text string")).collect()}
    want = plain_classes(table)
    assert got == want and 3 < len(set(want.values())) < 65


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.row_classes(docs).count() == near_dup.keep_rows(docs).count() == 0


def test_rows_with_shared_and_null_ids_are_compared(spark):
    rows = [(1, "b c d e f g"), (1, "a b c d e f"), (1, ""), (2, "B c d e f g"), (3, "x y"), (3, "x y"), (None, "x  y"), (None, "only here"),
            (None, "only here"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"], r["kept"]) for r in near_dup.row_classes(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True), (None, 3, False), (None, None, True), (None, None, True)], key=str)
    left = sorted(((r["doc_id"], r["text"]) for r in near_dup.keep_rows(docs).collect()), key=str)
    assert left == sorted([rows[0], rows[1], rows[2], rows[4], rows[7], rows[9], rows[10]], key=str)


def test_components_of_long_chains(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 102), (102, 101)], "a long, b long")
    got = {r["member"]: r["component"] for r in near_dup.components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}


ITEM = "If a train leaves Boston at 60 km per hour and 60 km later meets Alice , when will both of them reach the old station ?"


def test_leaks_exact_reparameterised_and_inconsistent(spark):
    bench = spark.createDataFrame([(1, ITEM, "q"), (2, "tiny item of five words", "q"), (3, None, "q"), (4, "", "q"), (5, "too short", "q"), (1, ITEM, "q")],
                                  "item_id int, text string, doc_id string")
    other = ITEM.replace("60", "80").replace("km", "miles").replace("Alice", "Bob")
    texts = [ITEM, "before it. " + other + " after it", ITEM.replace("60 km later", "61 km later"), "so tiny item of five words here", None, "", "1 2 3 4 5 6 7 8 " * 20,
             "too short", " ".join(ITEM.split()[:9]), "filler " * 4000 + other]
    docs = spark.createDataFrame([*[(k, t, 1) for k, t in enumerate(texts)], (None, ITEM, 2), (0, ITEM, 3), (0, "other", 3)], "doc_id long, text string, item_id int")
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(docs, bench).collect()}
    assert {k: r["kind"] for k, r in got.items()} == {
        (0, 1): "exact", (1, 1): "reparameterised", (3, 2): "exact", (9, 1): "reparameterised", (None, 1): "exact"}
    # Boston stays; 60, km (twice each) and Alice change.
    assert (got[1, 1]["n_slots"], got[1, 1]["n_changed"]) == (6, 5)
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 2, 4, 5, 6, 7, 8]
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0 and decontaminate.leaks(docs.limit(0), bench).count() == 0
    assert decontaminate.clean(docs, bench.limit(0)).count() == docs.count()


def found_leaks(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.leaks(docs, bench).collect()}


def test_leaks_of_items_with_many_placeholders(spark):
    items = ["What is 12 plus 34 minus 7?", "Tom has 5 apples and 3 pears.", "Return Of The Old Iron King", "12 7 19 44 3 8",
             "Add 3 and 4 and 5 to 6 7 8 9", "1 2 3 4 5 6 7 8 9 then stop here", "zero 1 2 3 4 5 6 7 8 9 end"]
    same = [f"some words first. {t} And more." for t in items]
    other = ["So. What is 15 plus 20 minus 9?", "Yes. Tom has 7 kg and 2 pears.", "Return By Some New Gold Man", "12 7 19 45 3 8",
             "add 4 and 5 and 6 to 7 8 9 1", "11 12 13 14 15 16 17 18 19 then stop here", "zero 9 8 7 6 5 4 3 2 1 end", "add 4 and 5 and 6 to 7 8 9 1 2",
             "1 2 3 4 5 6 7 8 and 1 2 3 4 5 6 7 8", "what is 12 times 34 minus 7"]
    got = found_leaks(spark, items, same + other)
    n = len(items)
    assert got == {**{(k, k): "exact" for k in range(n)}, **{(n + k, k): "reparameterised" for k in (0, 1, 4, 5, 6)}, (n + 7, 4): "reparameterised"}


def test_leaks_after_a_colon_and_inside_a_sentence(spark):
    items = ["What is the capital city of France?", "Which of these old rivers is the longest one of all?", "What is 12 plus 34 minus 7?", "name the tallest tree on earth"]
    before = ["Question: ", "Q: ", "they asked me ", "well, ", "So. "]
    texts = [b + t[0].upper() + t[1:] for t in items for b in before]
    texts += ["it is known: Paris is the capital city of France", "Q: What is 15 plus 20 minus 9?"]
    got = found_leaks(spark, items, texts)
    n = len(before)
    assert got == {**{(n * k + j, k): "exact" for k in range(len(items)) for j in range(n)}, (n * len(items) + 1, 2): "reparameterised"}


def test_leaks_with_shuffled_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SMALL_WINDOWS", 0)
    bench = spark.createDataFrame([(1, ITEM)], "item_id int, text string")
    assert decontaminate.leaks(spark.createDataFrame([(1, ITEM), (2, "x")], "doc_id long, text string"), bench).count() == 1


def test_pipeline_stages_take_effect(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(1)
    words = [f"term{k}" for k in range(500)]
    rows = [(k, " ".join(rng.choice(words) for _ in range(60)), "en", "s", 0) for k in range(40)]
    rows += [(40, rows[3][1] + " more", "en", "s", 0), (41, rows[3][1], "fr", "s", 0), (42, "few words", "en", "s", 0), (43, None, None, None, None),
             (44, rows[5][1].replace("term", "item") + " " + ITEM, "en", "s", 0), (45, " ".join(f"u{k}" for k in range(30)) + " call +1 555 123 4567", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        left.append({r["doc_id"]: r for r in kept.collect()})
    assert set(left[0]) == {*range(42), 44, 45}
    assert set(left[1]) == {*range(40), 44, 45}
    assert set(left[2]) == {*range(40), 45}
    assert left[3][45]["text"].endswith("call <phone>") and left[3][45]["n_chars"] == len(left[3][45]["text"])
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == set(left[3])
    whole = Counter()
    for r in pieces:
        whole[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert all(n == total for (_, total), n in whole.items())


APPLES = "Tom has 5 apples. Tom buys 3 more apples. Tom gives 2 apples to Anna. How many apples does Tom have now?"
EGGS = "A box of twelve eggs costs two dollars at the market. How much do seven such boxes cost?"
FOUND = [
    APPLES, APPLES.replace("Tom", "Bob"), APPLES.replace("Tom", "Bob").replace("5", "41").replace("3", "7"), APPLES.replace("Anna", "Maria"),
    "Question: " + APPLES.replace("Tom", "Eve"), "\u201c" + APPLES.replace("Tom", "Eve") + "\u201d", "text before\n" + APPLES.replace("Tom", "TOM"),
    APPLES.replace("5", "five").replace("3", "nine"), EGGS, EGGS.replace("twelve", "fifteen").replace("two", "three"), EGGS.replace("seven", "9"),
    "Bob has 8 apples and 2 pears.", "so: Tom has 5 apples and 3 pears.",
]
NOT_FOUND = [
    APPLES.replace("Tom gives", "Ben gives"), APPLES.replace("Tom", "Bob", 2), "Tom has nothing to do with the many apples of this market.",
    "How many dollars does a box cost at the market?",
]


def test_names_and_number_words_at_every_position(spark):
    docs = spark.createDataFrame(list(enumerate([*FOUND, *NOT_FOUND])), "doc_id long, text string")
    items = spark.createDataFrame([("apples", APPLES), ("eggs", EGGS), ("short", "Tom has 5 apples and 3 pears.")], "item_id string, text string")
    got = {r["doc_id"]: (r["item_id"], r["kind"]) for r in decontaminate.leaks(docs, items).collect()}
    assert sorted(got) == list(range(len(FOUND)))
    exact = {0, 8, 12}
    assert {k for k, (_, kind) in got.items() if kind == "exact"} - {6} == exact
    assert [got[k][0] for k in (1, 9, 11)] == ["apples", "eggs", "short"]
