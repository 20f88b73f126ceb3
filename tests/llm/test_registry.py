"""The registered queries on small tables: contract columns against brute force, nulls, empty and clashing tables."""

import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tesserae.llm import decontaminate, langid, line_templates, quality_model, registry, suffix_dedup
from tests.llm.test_operators import base_spans, docs, edit_brute, fingerprint_brute, remove_brute, repeats_brute, words

SF = "/root/testdata/sf0.001"
sha = lambda b: hashlib.sha256(b).hexdigest()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of small tables, and its texts by id."""
    rnd = random.Random(50)
    texts = {k: "\n".join(words(rnd, rnd.randint(1, 30)) for _ in range(rnd.randint(1, 4))) for k in range(60)}
    for k in range(60, 80):
        texts[k] = texts[k - 60] + (" ME@corp.example 10.1.2.3" if k % 2 else "")
    texts |= {90: None, 91: "", 92: "ab " * 200, 93: "<|endoftext|> é 😀", 94: "12 34"}
    folder = tmp_path_factory.mktemp("tables")
    rows = [(k, t, "en" if k % 2 else "fr", "s", 0) for k, t in texts.items()] + [(None, "no key", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, texts[5]), (1, "two words"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts


def rows_of(spark, corpus, name):
    got = registry.queries()[name](spark, corpus[0]).collect()
    return {r["doc_id"]: r for r in got if r["doc_id"] is not None}, got


def test_op1(spark, corpus):
    got, every = rows_of(spark, corpus, "op1_pii")
    assert len(every) == len(corpus[1]) + 1
    for k, t in corpus[1].items():
        want = base_spans(t)
        assert got[k]["base_sha256"] == sha(want.encode()) and got[k]["spans"].startswith(want)
        assert [got[k][f"n_{kind}"] for kind in ("email", "ip", "card", "phone")] == [len(re.findall(rf"\b{kind}:", want)) for kind in ("email", "ip", "card", "phone")]


def test_op3(spark, corpus):
    got, every = rows_of(spark, corpus, "op3_suffix_dedup")
    assert len(every) == len(corpus[1]) + 1
    for k, (n, removed, spans, kept) in remove_brute(corpus[1]).items():
        assert (got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], got[k]["kept_sha256"]) == (n, removed, spans, sha(kept))


def test_op4(spark, corpus):
    got, every = rows_of(spark, corpus, "op4_simhash")
    fps = {k: fingerprint_brute(t) for k, t in corpus[1].items()}
    assert {k: r["fingerprint"] for k, r in got.items()} == {k: f"{v:016x}" for k, v in fps.items()}
    label = {k: k for k in fps}
    for _ in fps:
        for a in fps:
            label[a] = min(label[b] for b in fps if (fps[a] ^ fps[b]).bit_count() <= 4)
    assert {k: r["component_id"] for k, r in got.items()} == label and len(every) == len(fps) + 1


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_op5_against_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    found = con.execute(registry.oracle_sql()["op5_url_reputation"])
    names = [d[0] for d in found.description]
    want = sorted((tuple(r[names.index(c)] for c in ("page_id", "host", "path", "rule", "verdict", "bound")) for r in found.fetchall()), key=str)
    got = registry.op5_url_reputation(spark, SF).select("page_id", "host", "path", "rule", "verdict", "bound").collect()
    assert sorted(map(tuple, got), key=str) == want


def test_op6(spark, corpus):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(registry.tokenizer_path())
    got, _ = rows_of(spark, corpus, "op6_bpe")
    for k, t in corpus[1].items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (got[k]["n_tokens"], got[k]["ids_sha256"], got[k]["decoded_sha256"]) == (len(ids), sha(np.array(ids, "<u4").tobytes()), sha(decoded.encode()))


def test_op7(spark, corpus):
    got = {(r["doc_id"], r["item_id"]) for r in registry.op7_decontaminate(spark, corpus[0]).collect()}
    assert got >= {(5, 0), (65, 0)} and all(i == 0 for _, i in got)


@pytest.mark.parametrize("name, of, part", [("op8_language", 4, 2), ("op9_quality_model", 3, 1)])
def test_op8_and_op9(spark, corpus, name, of, part):
    got, every = rows_of(spark, corpus, name)
    assert {k: r["held_out"] for k, r in got.items()} == {k: zlib.crc32(str(k).encode()) % of == part for k in corpus[1]}
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in every) and len(every) == len(corpus[1]) + 1
    if name == "op8_language":
        assert {k for k, r in got.items() if r["lang_pred"] == "und"} == {90, 91, 94}
        assert {r["lang_pred"] for r in every} <= {"en", "fr", "und"}
    else:
        assert all(r["predicted"] == (r["score"] >= 0.5) for r in every)


def test_op10(spark, corpus):
    got, _ = rows_of(spark, corpus, "op10_repetition")
    for k, t in corpus[1].items():
        n, chars, symbols, dup, repeated, _ = repeats_brute((t or "").encode())
        failed = n < 20 or 100 * repeated > 30 * n
        assert (got[k]["n_words"], got[k]["word_chars"], got[k]["n_symbols"], got[k]["n_dup_lines"], got[k]["n_repeat_words"], got[k]["base_failed"]) == (n, chars, symbols, dup, repeated, failed)
        assert not (failed and got[k]["kept"])


def recurring_brute(texts, depth=3, min_tokens=3, min_docs=5, min_docs_long=2, long_chars=60, constant=0.6, similar=0.75, levels=2):
    """Line -> smallest key, of the lines that recur; every text is a row."""

    def normal(line):
        line = re.sub("[ \t\r\f\x0b]+", " ", line)
        marked = re.sub(r"[^ ]*[0-9][^ ]*", "<*>", line).strip(" ")
        return marked if len(marked.split(" ")) >= min_tokens else line.strip(" ")

    has = {}
    for k, t in texts.items():
        for line in {normal(x) for x in (t or "").split("\n")}:
            if re.search(r"[^\W\d_]", line.replace("<*>", "")):
                has.setdefault(line, set()).add(k)
    least = {}

    def recur(lines, key):
        for x in lines:
            least[x] = min(key, least.get(x, key))

    for x, rows in has.items():
        if len(rows) >= min_docs or (len(rows) >= min_docs_long and len(x) >= long_chars and len(x.split(" ")) >= min_tokens):
            recur([x], min(rows))
    nodes = {}
    for x in has:
        tokens = x.split(" ")
        if len(tokens) > depth:
            nodes.setdefault((len(tokens), *tokens[:depth]), []).append(x)
    for _ in range(levels + 1):
        below = {}
        for node, lines in nodes.items():
            if len(lines) < 2 or sum(len(has[x]) for x in lines) < min_docs:
                continue
            rest = {x: x.split(" ")[depth:] for x in lines}
            support = {}
            for x, tokens in rest.items():
                for i, t in enumerate(tokens):
                    support[i, t] = support.get((i, t), 0) + len(has[x])
            total = sum(len(has[x]) for x in lines)
            fixed = {}
            for i in {i for i, _ in support}:
                n, t = max((n, t) for (j, t), n in support.items() if j == i)
                if n >= total * constant and n >= min_docs:
                    fixed[i] = t
            agreeing = [x for x, tokens in rest.items() if sum(fixed.get(i) == t for i, t in enumerate(tokens)) >= len(tokens) * similar]
            rows = set().union(*(has[x] for x in agreeing)) if agreeing else set()
            if len(rows) >= min_docs:
                recur(agreeing, min(rows))
                covered = set(agreeing)
            else:
                covered = set()
            for x, tokens in rest.items():
                if x in covered:
                    continue
                ways = [(support[i, t], -i, t) for i, t in enumerate(tokens) if fixed.get(i) != t and support[i, t] >= min_docs]
                if ways:
                    below.setdefault((node, max(ways)), []).append(x)
        nodes = below
    return {x: k for x, k in least.items()}, normal


def test_op2_against_a_brute_force_tree(spark):
    rnd = random.Random(60)
    names = [f"n{chr(97 + i)}{chr(97 + j)}" for i in range(5) for j in range(5)]
    shapes = ["copyright by the {a} group in town all rights kept", "copyright by the house of {a} since long and wide", "error at node {a} in rack alpha", "error at node {a} of row {b}", "Home News", "x", "12", "see page 7", "<p>"]
    texts = {}
    for k in range(70):
        lines = [rnd.choice(shapes).format(a=rnd.choice(names), b=rnd.choice(names)) for _ in range(rnd.randint(1, 5))]
        lines += [words(rnd, 8)] * (rnd.random() < 0.5) + ["a long line of exactly these very many words which two texts have in common"] * (k in (7, 9))
        texts[k] = "\n".join(lines)
    texts |= {80: None, 81: "", 82: "error at node na in rack alpha\nerror at node nb in rack alpha\nerror at node nc in rack alpha\n" * 50}
    least, normal = recurring_brute(texts)
    got = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(docs(spark, texts)).collect()}
    for k, t in texts.items():
        kept = [x for x in (t or "").split("\n") if least.get(normal(x), k) == k]
        assert got[k]["text"] == "\n".join(kept), k
        assert got[k]["n_dropped"] == len((t or "").split("\n")) - len(kept)
    assert any("house of" in x for x in least) and any("group in" in x for x in least)


def test_op2_counts_documents_once_and_finds_two_templates(spark):
    rows = {1: "\n".join(f"error at node {x} in rack alpha" for x in "abcd"), 2: "error at node e in rack alpha"}
    assert all(r["n_dropped"] == 0 for r in line_templates.drop_recurring_lines(docs(spark, rows)).collect())
    two = {k: f"copyright by the {'north house' if k < 6 else 'south branch'} of {chr(97 + k)}{chr(98 + k)} and all its people" for k in range(12)}
    got = {r["doc_id"]: r["n_dropped"] for r in line_templates.drop_recurring_lines(docs(spark, two)).collect()}
    assert got == {k: int(k not in (0, 6)) for k in range(12)}


def test_op7_finds_every_window_in_its_budget(spark):
    rnd = random.Random(61)
    letters = "abcdefghijklmnopqrstuvwxyz      "
    item = re.sub(" +", " ", "".join(rnd.choice(letters) for _ in range(150))).strip()
    short = "what is two plus two? four"
    texts = {}
    for k in range(40):
        at = rnd.randrange(0, len(item) - 72)
        part = list(item[at : at + 72])
        for _ in range(k % 8):
            p = rnd.randrange(len(part))
            rnd.choice([lambda: part.pop(p), lambda: part.insert(p, "z"), lambda: part.__setitem__(p, "q")])()
        texts[k] = words(rnd, 20) + " " + "".join(part) + " " + words(rnd, 20)
    texts[50], texts[51], texts[52] = f"Well: What is TWO plus two?  four, said he", "two words", "two words more"
    bench = spark.createDataFrame([(1, item), (2, short), (3, "Two  words")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(spark, texts), bench).collect()}
    own = decontaminate.normalised(item.encode())
    starts = {*range(0, len(own) - 63, 8), len(own) - 64}
    budget = decontaminate.budget(64, 0.08)
    for k in range(40):
        text = decontaminate.normalised(texts[k].encode())
        assert ((k, 1) in got) == (min(edit_brute(own[s : s + 64], text) for s in starts) <= budget), k
    assert {(k, i) for k, i in got if k >= 50} == {(50, 2), (51, 3)}


def test_op3_long_text_and_hot_passage(spark):
    rnd = random.Random(62)
    passage = words(rnd, 30)
    texts = {k: f"{words(rnd, rnd.randint(0, 6))} {passage[rnd.randint(0, 3):]} {words(rnd, rnd.randint(0, 6))}" for k in range(120)}
    texts[200] = " ".join(words(rnd, 12) for _ in range(4000)) + passage
    texts[201] = texts[200][100:60_000] + "end"
    want = {k: (v[1], v[2], v[3]) for k, v in remove_brute(texts).items()}
    for hot in (10_000, 3):  # beyond it an owner goes on as single windows
        got = {r["doc_id"]: (r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.drop_repeats(docs(spark, texts), hot=hot).collect()}
        assert got == want
    with pytest.raises(TypeError):
        suffix_dedup.drop_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_pipeline_on_empty_tables_and_extra_columns(spark, tmp_path, corpus):
    bench = spark.read.parquet(f"{corpus[0]}/benchmark.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    given = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    extra = {c: F.lit("x") for c in ("key", "text_", "line", "leaf", "node", "h", "row", "gone", "item", "rest")}
    for table in (given.limit(0), given.withColumns(extra)):
        found = table
        for name, stage in corpus_pipeline.STAGES:
            found = corpus_pipeline.cut(stage(spark, found, str(tmp_path)))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert found.columns == table.columns
        assert (found.count() == 0) == (table.limit(1).count() == 0)


def test_scores_of_empty_tables(spark):
    none = docs(spark, [])
    assert langid.identify(none, langid.fit(none)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality_model.score(none, quality_model.fit(none, labels)).count() == 0
    assert decontaminate.contaminated(none, spark.createDataFrame([(1, "some benchmark item of a few words")], "item_id long, text string")).count() == 0
