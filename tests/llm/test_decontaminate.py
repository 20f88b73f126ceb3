"""Decontamination of texts that repeat, in bounded parts, and short items."""

import random
import subprocess
import sys

import numpy as np
import pytest

from tesserae.llm import decontaminate
from tests.llm.test_operators import docs, edit_brute, words

OPTIONS = {"window": 64, "stride": 8, "rate": 0.08, "least": 16}


def found(items, texts):
    index = decontaminate.Index.build([(i, x.encode()) for i, x in enumerate(items)], **OPTIONS)
    gap, clean = b"\0" * 128, [decontaminate.normalised(t.encode()) for t in texts]
    return decontaminate.matches(index, np.frombuffer(gap.join([*clean, b""]), np.uint8), np.cumsum([len(t) + 128 for t in clean]))


def brute(items, texts):
    """Every window of every item against every text; pieces that cannot match by q-grams are as far as any."""
    out = {}
    for t, text in enumerate(map(lambda x: decontaminate.normalised(x.encode()), texts)):
        for i, item in enumerate(map(lambda x: decontaminate.normalised(x.encode()), items)):
            last = max(0, len(item) - 64)
            edits = [(edit_brute(item[s : s + 64], text), decontaminate.budget(len(item[s : s + 64]), 0.08)) for s in sorted({*range(0, last + 1, 8), last})]
            near = [e for e, most in edits if e <= most]
            if near:
                out[t, i] = (len(near), min(near))
    return out


def repeating(rnd, n):
    out = ""
    while len(out) < n:
        out += rnd.choice([rnd.choice("-=*") * rnd.randint(1, 90), words(rnd, rnd.randint(1, 6)), "+" + "-" * 30 + "+", " | " * rnd.randint(1, 12)])
    return out[:n]


def test_repeats_against_all_windows(monkeypatch):
    rnd = random.Random(21)
    items = [repeating(rnd, rnd.choice([20, 70, 130])) for _ in range(7)] + ["-" * 150]
    texts = [repeating(rnd, 260) for _ in range(6)] + ["-" * 300, items[1] + repeating(rnd, 50), repeating(rnd, 70) + items[2][:50] + "?" + items[2][50:]]
    want = brute(items, texts)
    assert len(want) > 8
    assert found(items, texts) == want
    for hits in (50, 900):  # many parts of the text, and of the windows
        monkeypatch.setattr(decontaminate, "HITS", hits)
        assert found(items, texts) == want


def test_one_character_a_million_times():
    """A megabyte of one character against 2,000 of it stays below 500 MB."""
    code = (
        "import resource; from tests.llm.test_decontaminate import found; assert found(['-' * 2000], ['-' * 1_000_000]) == {(0, 0): (243, 0)}; "
        "print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=200)
    assert int(done.stdout) < 500, done.stderr


def test_short_items(spark):
    items = {0: "東京都の人", 1: "Ja und nein", 2: "yes", 3: "a-b c", 4: "四字"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    texts = ["これは東京都の人です", "er sagt ja  UND\nnein.", "yes we say yes", "YES", "xa-b c", "(a-b c)", "ja und neins", "四字の", "四字", "la-b c, a-b cd, a-b  c", ""]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(spark, texts), bench).collect()}
    assert got == {(0, 0), (1, 1), (3, 2), (5, 3), (8, 4), (9, 3)}


def test_wrong_options(spark):
    frame = docs(spark, ["a"])
    for wrong in ({"window": 12}, {"rate": 1.5}, {"rate": -0.1}, {"stride": 0}, {"least": 4}):
        with pytest.raises(ValueError):
            decontaminate.contaminated(frame, frame, item_key="doc_id", **wrong)


def test_very_long_text(spark):
    rnd = random.Random(22)
    item = words(rnd, 40)
    long = words(rnd, 60_000) + " " + item + " " + words(rnd, 60_000)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [(r["doc_id"], r["edits"]) for r in decontaminate.contaminated(docs(spark, [long, long, "x"]), bench).collect()] == [(0, 0), (1, 0)]
