"""Bottom-k near-duplicates against all pairs of sets, and the registered query against its SQL."""

import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tesserae.llm import bottom_k, registry
from tests.llm.test_operators import clashing, docs


def shingle_set(text, size=4):
    w = (text or "").lower().split() if (text or "").isascii() else (text or "").encode().lower().split()
    w = [x if isinstance(x, bytes) else x.encode() for x in w]
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(texts, percent=80):
    sets = {k: shingle_set(t) for k, t in texts.items()}
    least = {k: k for k in texts}

    def root(k):
        while least[k] != k:
            k = least[k]
        return k

    keys = sorted(texts)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {k: (len(sets[k]), root(k), root(k) == k) for k in keys}


def corpus(rnd):
    """Copies, near copies in chains and about a centre, a passage that all share, short and long texts."""
    word = lambda: f"w{rnd.randint(0, 4000)}"
    passage, texts = [word() for _ in range(60)], []
    for _ in range(60):
        base = [word() for _ in range(rnd.choice([3, 8, 30, 120, 400]))]
        texts.append(base)
        for _ in range(rnd.randint(0, 3)):
            copy = list(rnd.choice(texts[-2:]))
            for _ in range(int(len(copy) * rnd.choice([0, 0.01, 0.03, 0.05, 0.06]))):
                copy[rnd.randrange(len(copy))] = word()
            texts.append(copy)
    texts += [passage + [word() for _ in range(rnd.randint(5, 60))] for _ in range(60)]
    centre = [word() for _ in range(300)]
    texts += [[x if rnd.random() > 0.012 else word() for x in centre] for _ in range(60)]
    rnd.shuffle(texts)
    return dict(enumerate(" ".join(t) for t in texts))


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_against_all_pairs(spark):
    texts = corpus(random.Random(6))
    want = brute(texts)
    assert 40 < sum(not kept for _, _, kept in want.values())
    frame = clashing(docs(spark, texts)).withColumns({"n": F.lit(1), "digest": F.lit("x"), "sketch": F.lit("x"), "node": F.lit("x")})
    assert result(bottom_k.near_duplicates(frame)) == want
    assert result(bottom_k.near_duplicates(docs(spark, texts), percent=60, k=64)) == brute(texts, 60)


def test_large_lists(spark, monkeypatch):
    """Lists that are made anew from whole sets give the same links."""
    monkeypatch.setattr(bottom_k, "LARGE", 3)
    texts = corpus(random.Random(12))
    assert result(bottom_k.near_duplicates(docs(spark, texts), k=64)) == brute(texts)


def test_union_sketch_bound():
    """Sketches of sets of similarity 0.8 share the needed values; far apart sets do not."""
    rnd = np.random.default_rng(8)
    for k in (64, 128):
        c = bottom_k.needed(k, 80)
        for similar in (True, False):
            for _ in range(200):
                union = np.unique(rnd.integers(0, 1 << 62, 1000))
                part = rnd.permutation(len(union))
                both, rest = (800, 200) if similar else (100, 900)
                a, b = union[np.sort(part[: both + rest // 2])], union[np.sort(np.r_[part[:both], part[both + rest // 2 :]])]
                shared = np.isin(union[:k], a) & np.isin(union[:k], b)
                assert (shared.sum() >= c) == similar
                assert shared.sum() <= len(np.intersect1d(a[:k], b[:k]))


def test_limits(spark):
    """The bound itself counts: 4 of 5 shingles link, 3 of 4 do not."""
    texts = {5: "a b c d e f g h", 4: "a b c d e f g x", 3: "a b c d e f g", 2: "A B\tC d  e f", 9: "p q r s t u v", 8: "p q r s t u w", 7: "p q r", 6: "p  Q r", 1: "É a", 0: "é a"}
    got = result(bottom_k.near_duplicates(docs(spark, texts)))
    assert got == brute(texts) and got[7][1] == 6 and got[3][1] == 3


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "  \n"), (4, "same text here now"), (5, "same text here now"), (5, "same text here now"), (None, "same text here now"), (7, "one"), (7, "two"), (8, "two")]
    frame = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((tuple(r) for r in bottom_k.near_duplicates(frame).collect()), key=str)
    want = [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (5, 1, 4, False), (None, 1, None, True), (7, 1, 7, True), (7, 1, 7, True), (8, 1, 7, False)]
    assert got == sorted(want, key=str)
    assert bottom_k.near_duplicates(docs(spark, [])).count() == 0
    assert bottom_k.near_duplicates(docs(spark, [None, ""])).count() == 2


def test_query(spark, tmp_path):
    texts = {k: t for k, t in corpus(random.Random(9)).items() if k < 150} | {200: None, 201: ""}
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = result(registry.queries()["op13_bottom_k"](spark, str(tmp_path)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = con.execute(registry.oracle_sql()["op13_bottom_k"])
    names = [d[0] for d in found.description]
    assert got == {r[names.index("doc_id")]: tuple(r[names.index(c)] for c in ("n_shingles", "component_id", "kept")) for r in found.fetchall()} == brute(texts)
