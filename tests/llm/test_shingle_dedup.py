"""The pipeline's near-dedup stage: every pair of similarity 0.8 or more is joined, compared with brute force."""

import random

import corpus_pipeline
from tesserae.llm import shingle_dedup


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def groups(texts):
    sets = {k: shingle_set(t) for k, t in texts.items()}
    label = {k: k for k in texts}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if label[b] < label[a] and jaccard(sets[a], sets[b]) >= 0.8:
                    label[a], changed = label[b], True
    return label


def corpus():
    rnd = random.Random(21)
    vocabulary = ["".join(rnd.choice("aeiourstlnmd") for _ in range(rnd.randint(3, 9))) for _ in range(900)]
    prose = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    common = prose(20)
    texts = {k: " ".join(prose(rnd.randint(60, 250)) + common * (k % 3 == 0)) for k in range(40)}
    for k in range(40):  # edited copies on both sides of the border
        w = texts[k].split()
        for p in rnd.sample(range(len(w)), max(1, len(w) * (k % 8 + 1) // 200)):
            w[p] = "changed" + str(p)
        texts[100 + k] = " ".join(w).upper()
    base = prose(120)
    for k in range(60):  # a large group of near copies that are not all near each other
        w = list(base)
        for p in rnd.sample(range(120), k % 2 + 1):
            w[p] = "other" + str(k)
        texts[200 + k] = " ".join(w)
    chain = prose(100)
    for k in range(6):  # a chain whose ends are far apart
        texts[300 + k] = " ".join(chain[k * 8 :] + prose(k * 8))
    return texts | {400: None, 401: "", 402: "two words", 403: "Two  words", 404: "two words more"}


def rows(spark, texts):
    return spark.createDataFrame([(k, t, "en", "s", None) for k, t in texts.items()] + [(None, texts[0], "en", "s", None)], "doc_id long, text string, lang string, source string, n_chars long")


def test_stage_joins_all_pairs_of_similarity(spark, tmp_path):
    texts = corpus()
    left = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, rows(spark, texts), str(tmp_path)).collect()]
    assert left.count(None) == 1
    assert {k for k in left if k is not None} == set(groups(texts).values())


def test_groups_equal_brute_force(spark):
    texts = corpus()
    want = groups(texts)
    for sample_rows in (10_000, 1):
        got = shingle_dedup.near_duplicates(rows(spark, texts), sample_rows=sample_rows).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert sum(want[100 + k] == k for k in range(40)) >= 20


def test_no_rows(spark):
    assert shingle_dedup.near_duplicates(rows(spark, corpus()).limit(0)).count() == 0
