"""Periodic runs against a comparison of all shifts, and the registered query against its definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tesserae.llm import periodic_runs, registry
from tests.llm.test_operators import clashing, docs


def brute(words, least=12):
    numbers = {}
    x, out = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64), {}
    for q in range(1, len(x) // 2 + 1):
        same = np.diff(np.r_[0, (x[q:] == x[:-q]).astype(int), 0])
        for s, e in zip(np.flatnonzero(same == 1).tolist(), (np.flatnonzero(same == -1) + q).tolist()):
            if e - s >= max(least, 2 * q):
                out.setdefault((s, e), q)
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def nested(rnd, depth):
    if not depth:
        return [rnd.choice("ab") for _ in range(rnd.randint(1, 3))]
    return [w for _ in range(rnd.randint(1, 3)) for w in nested(rnd, depth - 1) * rnd.randint(1, 5)]


def test_nested_repeats():
    rnd, seen = random.Random(1), 0
    for _ in range(150):
        block = []
        for _ in range(3):
            w = nested(rnd, rnd.randint(2, 4))[:900]
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(len(w))] = "c"
            block.append(w * rnd.choice([1, 1, 3]))
        got, kept = periodic_runs.measure([" ".join(w).encode() for w in block])
        for w, runs, text in zip(block, got, kept):
            assert runs == brute(w)
            assert text.decode() == collapsed(w, runs)
            seen += len(runs)
    assert seen > 1000


def test_runs_that_touch():
    """Two runs of one period that share a word give runs of many longer periods."""
    w = list("aab" * 13 + "a" + "aab" * 13)
    assert periodic_runs.measure([" ".join(w).encode()])[0][0] == brute(w)


def test_range_successor():
    rnd = np.random.default_rng(2)
    for bits in (1, 5, 9):
        values = rnd.integers(0, 1 << bits, 300)
        tree = periodic_runs.WaveletMatrix(values, bits)
        lo = rnd.integers(0, 300, 200)
        hi = np.minimum(300, lo + rnd.integers(0, 60, 200))
        x = rnd.integers(0, (1 << bits) + 3, 200)
        for a, b, c, up, down in zip(lo, hi, x, tree.successor(lo, hi, x), tree.predecessor(lo, hi, x)):
            part = values[a:b]
            assert up == min(part[part >= c], default=-1)
            assert down == max(part[part < c], default=-1)


def test_long_texts():
    """A million equal words, and a period of 777: time and memory follow the text."""
    assert periodic_runs.measure([b"a " * 300_000])[0] == [[(0, 300_000, 1)]]
    assert periodic_runs.measure([b" ".join(str(i % 777).encode() for i in range(100_000))])[0] == [[(0, 100_000, 777)]]


def test_edges(spark):
    texts = [None, "", " \t ", "a " * 12, "a " * 11, "a b " * 6, "a\vb\fc " * 4 + "x", "é " * 13]
    frame = docs(spark, texts).union(docs(spark, {None: "a " * 12, 3: "a " * 12}))
    rows = periodic_runs.periodic_runs(clashing(frame).withColumn("runs", F.lit(1))).collect()
    assert len(rows) == 10 and rows[0].asDict().keys() == {"doc_id", "n_words", "runs", "collapsed"}
    by = {r["doc_id"]: r for r in rows}
    assert [tuple(map(tuple, by[k]["runs"])) for k in range(8)] == [(), (), (), ((0, 12, 1),), (), ((0, 12, 2),), ((0, 12, 3),), ((0, 13, 1),)]
    assert by[6]["collapsed"] == "a b c x" and by[None]["collapsed"] == "a" and by[0]["collapsed"] == "" and by[4]["n_words"] == 11
    assert periodic_runs.periodic_runs(docs(spark, [])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(frame, least=6)


def test_query(spark, tmp_path):
    rnd = random.Random(7)
    texts = {k: " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 120))) for k in range(400)} | {400: None, 401: ""}
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in registry.queries()["op12_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(got) == 402
    planted = 0
    for k, t in texts.items():
        w, h = (t or "").split(), zlib.crc32(str(k).encode())
        g = h // 10
        if h % 10 == 0 and w:
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w, planted = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)], planted + 1
        runs = brute(w)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        row = got[k]
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"], row["exponent_milli"]) == ((*best, best[1] * 1000 // best[2]) if best else (None,) * 4)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert planted > 20
