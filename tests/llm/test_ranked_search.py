"""Ranked search against scores of all documents, and the registered query against its SQL."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from tesserae.llm import ranked_search, registry
from tests.llm.test_operators import clashing

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))


def brute(texts, items, k=10):
    """``item, rank, key, score`` from ``(key, text)`` and ``(item, text)`` rows."""
    bags = [(key, Counter(split(t))) for key, t in texts]
    bags = [(key, b) for key, b in bags if b]
    total, df = sum(sum(b.values()) for _, b in bags), Counter(t for _, b in bags for t in b)
    weight = lambda t: math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * df[t] + 1)))
    out = []
    for item, text in items:
        scores = []
        for key, b in bags:
            m = 25 + 75 * sum(b.values()) * len(bags) // total
            score = sum(weight(t) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in split(text) if t in b)
            if score > 0 and key is not None:
                scores.append((-score, key))
        out += [(item, rank, key, -score) for rank, (score, key) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()))


def corpus(rnd):
    some = lambda n: " ".join(rnd.choices("the of to é Straße 42 x-ray NAÏVE a1 b2 c3 d4 e5 f6 g7 h8".split(), [9, 8, 7, 1, 1, 1, 2, 1, *[1] * 8], k=n))
    texts = [(k, some(rnd.choice([5, 5, 5, rnd.randint(0, 90)]))) for k in range(500)]
    texts += [(500 + k, texts[3][1]) for k in range(40)]  # ties
    texts += [(600, None), (601, ""), (602, " ... "), (603, "the " * 30000), (None, "é é é"), (7, texts[8][1])]
    items = [(k, some(rnd.randint(1, 12))) for k in range(25)] + [(30, None), (31, "?"), (32, "nowhere"), (33, texts[3][1]), (33, "é é É")]
    return texts, items


def frames(spark, texts, items):
    return spark.createDataFrame([(k, t, "en", "s", 0) for k, t in texts], "doc_id long, text string, lang string, source string, n_chars long"), spark.createDataFrame(items, "item_id long, text string")


def test_against_all_scores(spark):
    texts, items = corpus(random.Random(3))
    left, right = frames(spark, texts, items)
    want = brute(texts, items)
    assert rows(ranked_search.search(clashing(left).withColumn("score", F.lit(1)), right.withColumn("rank", F.lit(1)))) == want
    assert rows(ranked_search.search(left.repartition(7), right, block_bytes=60)) == want  # queries in several blocks
    assert rows(ranked_search.search(left, right, k=3)) == brute(texts, items, 3)


def test_strata_are_left_out(monkeypatch):
    """Visits end at the bound; the result is that of all strata, also in small segments and with large weights."""
    rnd = np.random.default_rng(4)
    sizes, m = rnd.integers(1, 30, 3000), np.sort(rnd.integers(25, 400, 3000))
    ids, tfs = np.concatenate([rnd.choice(50, n, replace=False) for n in sizes]), rnd.geometric(0.4, sizes.sum())
    keys, visited, sums = rnd.permutation(3000), [], ranked_search._sums
    monkeypatch.setattr(ranked_search, "_sums", lambda at, *rest: visited.append(len(at)) or sums(at, *rest))
    for factor in (1, 1 << 33):
        weight = rnd.integers(1, 9, 50) * factor
        asked = np.array([0, 7, 30])
        best = ranked_search.Segment(keys, m, sizes, ids, tfs, 50).search(asked, weight[asked], 10, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        doc, scores = np.repeat(np.arange(3000), sizes), np.zeros(3000, np.int64)
        np.add.at(scores, doc, np.where(np.isin(ids, asked), weight[ids], 0) * (10**9 * tfs // (1000 * tfs + 8 * m[doc])))
        order = np.lexsort((keys, -scores))[:10]
        assert best[0].tolist() == keys[order].tolist() and best[1].tolist() == scores[order].tolist()
    assert sum(visited) < 2 * np.isin(ids, asked).sum()


def test_empty_tables(spark):
    left, right = frames(spark, [(1, "a")], [(1, "a")])
    for a, b in ((left.limit(0), right), (left, right.limit(0)), (left.where("doc_id IS NULL"), right)):
        got = ranked_search.search(a, b)
        assert got.count() == 0 and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_query(spark, tmp_path):
    texts, items = corpus(random.Random(5))
    texts, items = [x for x in texts if x[0] not in (None, 7)], items[:-1]
    left, right = frames(spark, texts, items)
    left.write.parquet(f"{tmp_path}/documents.parquet")
    right.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = rows(registry.queries()["op11_ranked_search"](spark, str(tmp_path)))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    found = con.execute(registry.oracle_sql()["op11_ranked_search"])
    at = [[d[0] for d in found.description].index(c) for c in ("item_id", "rank", "doc_id", "score")]
    assert got == sorted(tuple(r[i] for i in at) for r in found.fetchall()) == brute(texts, items)
