"""Each operator against brute force on small tables, with nulls, empty and repeated rows, and clashing names."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tesserae.llm import bpe, decontaminate, langid, line_templates, pii, quality_model, repetition, simhash, suffix_dedup, url_reputation
from tesserae.llm.registry import URL_RULES, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, lang=None):
    rows = [(k, t, (lang or {}).get(k), "s", None) for k, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
    return spark.createDataFrame(rows, DOCS)


def clashing(df):
    """Extra columns with the names that the operators use inside."""
    return df.withColumns({c: F.lit("x") for c in ("key", "fp", "h", "near", "hits", "lines", "gone", "shard", "rest", "term", "spans_email", "token_ids")})


def words(rnd, n):
    return " ".join(rnd.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau".split()) + str(rnd.randint(0, 99)) * (rnd.random() < 0.1) for _ in range(n))


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            v = m[0]
            d = re.sub("[^0-9]", "", v)
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in v.split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii_base_spans(spark):
    rnd = random.Random(4)
    pieces = ["a@b.c", "_d@e.f", "x.y@mail.example.com", "1.2.3.4", "256.1.1.1", "0001.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+44", " ", "é", "😀", "12", "@", ".", "-", "foo", "\n", "4111111111111111", "1.2.3", "%", "+1 "]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 14))) for _ in range(400)] + [None, "", "1 " * 30000, "a" * 50000, "a.b@" * 3000, "1." * 9000]
    got = pii.sanitise(clashing(docs(spark, texts))).select("doc_id", F.array_join(pii.joined(*(f"spans_{k}" for k in pii.KINDS)), ",").alias("s")).collect()
    assert len(got) == len(texts)
    for row in got:
        assert row["s"] == base_spans(texts[row["doc_id"]]), texts[row["doc_id"]]


def test_pii_terms_that_give_an_entity_away(spark):
    rnd = random.Random(5)
    texts = [words(rnd, 60) for _ in range(60)]
    for k in range(6):
        texts[k] += f" {words(rnd, 4)} Zanzibarius wrote from boss@corp.example about {words(rnd, 5)}"
    texts[50] += " Zanzibarius again"
    found = {r["doc_id"]: r for r in pii.sanitise(docs(spark, texts)).collect()}
    spans = found[50]["spans_term"]
    assert [texts[50][s["start"] : s["end"]] for s in spans] == ["Zanzibarius"]
    assert "Zanzibarius" not in found[50]["sanitised"] and "boss@corp" not in found[0]["sanitised"]
    assert found[40]["spans_term"] == [] and found[40]["sanitised"] == texts[40]


def test_pii_of_many_matches_in_one_text(spark):
    text = " ".join(f"user{k}@mail.example.com 10.0.{k % 256}.{k // 256}" for k in range(5_000))
    row = pii.sanitise(docs(spark, [text])).select(F.array_join(pii.joined("spans_email", "spans_ip"), ",").alias("s"), F.length("sanitised").alias("n")).first()
    assert row["s"] == base_spans(text) and row["n"] == len(" ".join(["<email> <ip>"] * 5_000))


def replaced(text, spans):
    """The text with each span replaced, by hand; ``spans`` are start, end, kind, value."""
    out, at = [], 0
    for start, end, kind, value in sorted(spans):
        if start >= at:
            out += [text[at:start], value if kind == "term" else f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_pii_replaces_spans_that_overlap_and_cross_pieces(spark):
    rnd = random.Random(36)
    rows = []
    for i in range(200):
        text = "".join(rnd.choice("aéb 😀\n") for _ in range(rnd.choice([0, 5, 1023, 1024, 1025, 2048, 5000])))
        starts = [rnd.randrange(len(text)) for _ in range(rnd.choice([0, 1, 3, 400]))] if text else []
        rows.append((i, text, [(a, min(len(text), a + rnd.choice([1, 3, 2000])), rnd.choice(["term", "ip"]), f"X{rnd.randrange(3)}") for a in starts]))
    table = spark.createDataFrame(rows, "i int, text string, spans array<struct<start: int, end: int, kind: string, value: string>>")
    got = table.select("i", pii._sanitised(F.col("text"), F.col("spans")).alias("out")).collect()
    assert all(r["out"] == replaced(*rows[r["i"]][1:]) for r in got) and len(got) == 200


@pytest.mark.parametrize("many", [64, 0])
def test_pii_terms_in_a_text_of_many_matches(spark, monkeypatch, many):
    monkeypatch.setattr(pii, "MANY", many)
    rnd = random.Random(37)
    names = ["Zanzibarius", "Quixotenberg", "Übermannsen"]
    texts = [words(rnd, 60) for _ in range(60)]
    for k in range(18):
        texts[k] += f" {words(rnd, 4)} {names[k % 3]} wrote from boss{k % 3}@corp.example about {words(rnd, 5)}"
    texts[50] = " ".join(f"{names[k % 3]} user{k}@mail.example.com x@{names[k % 3]}.example" for k in range(3_000))
    row = {r["doc_id"]: r for r in pii.sanitise(docs(spark, texts)).collect()}[50]
    taken = {i for k in pii.ALL for s in row[f"spans_{k}"] for i in range(s["start"], s["end"])}
    free = [m.span() for m in re.finditer("|".join(names), texts[50]) if taken.isdisjoint(range(*m.span()))]
    assert [(s["start"], s["end"]) for s in row["spans_term"]] == free and len(free) == 4_000  # "Ü" is in no address
    every = [(s["start"], s["end"], s["kind"], s["value"]) for k in (*pii.ALL, "term") for s in row[f"spans_{k}"]]
    assert row["sanitised"] == replaced(texts[50], every)


def test_pii_counts_rows_once(spark):
    rnd = random.Random(35)
    texts = [words(rnd, 40) + " contact us" for _ in range(80)]
    texts[0] = " ".join(f"{words(rnd, 3)} contact root@corp.example {words(rnd, 3)}" for _ in range(30))
    for k in (1, 2):
        texts[k] += f" {words(rnd, 6)} contact root@corp.example {words(rnd, 6)}"
    assert all(r["spans_term"] == [] for r in pii.sanitise(docs(spark, texts)).collect() if r["doc_id"] > 2)


def test_pii_secrets(spark):
    secret = "9233a8ecf7c5b09fe5949719b6b82bc439e9329b"
    row = pii.sanitise(docs(spark, [f'token = "{secret}" and averyveryverylongwordwithoutdigits 00000000000000000000001a'])).first()
    assert [(s["start"], s["end"], s["value"]) for s in row["spans_secret"]] == [(9, 49, secret)] and secret not in row["sanitised"]


def test_pii_of_an_empty_table(spark):
    assert pii.sanitise(docs(spark, [])).count() == 0


def test_line_templates(spark):
    rnd = random.Random(6)
    texts = {k: "\n".join([words(rnd, 12), f"Posted on day {k} of the site", words(rnd, 9), "Home News"]) for k in range(1, 9)} | {20: None, 21: "", 22: "Posted on day 99 of the site"}
    got = {r["doc_id"]: r for r in line_templates.drop_recurring_lines(clashing(docs(spark, texts))).collect()}
    assert len(got) == len(texts)
    assert got[1]["text"] == texts[1] and got[1]["n_dropped"] == 0  # the smallest key keeps its line
    for k in range(2, 9):
        lines = texts[k].split("\n")
        assert got[k]["text"] == "\n".join([lines[0], lines[2]]) and got[k]["n_dropped"] == 2  # the template and the short line
    assert got[22]["text"] == "" and got[20]["text"] == "" and got[20]["n_lines"] == 1


def test_line_templates_generalise_words(spark):
    rnd = random.Random(7)
    names = ["Anna", "Bert", "Carl", "Dora", "Emil", "Fred", "Gerd", "Hans"]
    texts = {k: f"Written by our author {n} for the weekly news\n{words(rnd, 10)}" for k, n in enumerate(names)}
    got = {r["doc_id"]: r["n_dropped"] for r in line_templates.drop_recurring_lines(docs(spark, texts), depth=3).collect()}
    assert got == {0: 0} | {k: 1 for k in range(1, 8)}


def test_line_templates_repeated_and_null_keys(spark):
    rows = [(1, "a b c d e")] * 3 + [(None, "a b c d e")] + [(2, "a b c d e"), (3, "other words stand here")]
    got = line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_dropped"]) for r in got) == [("1", 0)] * 3 + [("2", 1), ("3", 0), ("None", 1)]


def remove_brute(texts):
    seen, out = set(), {}
    for k in sorted(texts):
        b = (texts[k] or "").encode()
        cover = bytearray(len(b))
        own = [b[i : i + 50] for i in range(len(b) - 49)]
        for i, w in enumerate(own):
            if w in seen:
                cover[i : i + 50] = b"\1" * 50
        seen.update(own)
        spans = sum(1 for i in range(len(b)) if cover[i] and (i == 0 or not cover[i - 1]))
        out[k] = (len(b), sum(cover), spans, bytes(x for x, c in zip(b, cover) if not c))
    return out


def test_suffix_order():
    rnd = random.Random(2)
    for _ in range(600):
        letters = rnd.choice([[2], [2, 3], [2, 3, 4, 5], list(range(2, 300))])
        text = [rnd.choice(letters) for _ in range(rnd.randint(0, 60))]
        if rnd.random() < 0.3:
            text = text[: rnd.randint(1, 5)] * rnd.randint(1, 12)
        text = [*text, 0]
        assert suffix_dedup.suffix_order(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_order_of_a_rising_text():
    text = [*range(2, 20_002), 0]
    assert suffix_dedup.suffix_order(text) == [20_000, *range(20_000)]


def test_suffix_dedup(spark):
    rnd = random.Random(8)
    shared = [words(rnd, 30) for _ in range(4)]
    texts = {}
    for k in range(60):
        parts = [rnd.choice(shared) if rnd.random() < 0.4 else words(rnd, 15) for _ in range(rnd.randint(1, 4))]
        t = " é ".join(parts)
        if rnd.random() < 0.5 and len(t) > 5:
            p = rnd.randrange(len(t))
            t = t[:p] + "#" + t[p + 1 :]
        texts[k * 3] = t
    texts |= {200: None, 201: "", 202: "a" * 300, 203: "b" + "a" * 120, 204: texts[3], 205: "ab" * 100, 206: "ab" * 40}
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.drop_repeats(clashing(docs(spark, texts))).collect()}
    assert got == remove_brute(texts)


def test_suffix_dedup_keys(spark):
    text = words(random.Random(1), 40)
    rows = [(1, text), (1, text), (None, text), (5, text + " more words after it to differ")]
    got = suffix_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_removed"] > 0) for r in got) == [("1", False), ("1", False), ("5", True), ("None", False)]
    assert suffix_dedup.drop_repeats(docs(spark, [])).count() == 0


def fingerprint_brute(text):
    import xxhash

    w = re.findall(rb"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode())
    if not w:
        return 0
    s = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark):
    rnd = random.Random(9)
    texts = {k: words(rnd, rnd.randint(0, 60)) for k in range(40)}
    for k in range(40, 80):
        w = texts[k - 40].split()
        if w:
            w[rnd.randrange(len(w))] = "CHANGED"
        texts[k] = " ".join(w)
    texts |= {100: None, 101: "", 102: "ÀB cD"}
    got = {r["doc_id"]: r for r in simhash.near_duplicates(clashing(docs(spark, texts))).collect()}
    fps = {k: fingerprint_brute(t) for k, t in texts.items()}
    assert {k: r["fp"] & (1 << 64) - 1 for k, r in got.items()} == fps
    label = {k: k for k in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            for b in fps:
                if bin(fps[a] ^ fps[b]).count("1") <= 4 and label[b] < label[a]:
                    label[a], changed = label[b], True
    assert {k: r["component_id"] for k, r in got.items()} == label
    left = simhash.drop_near_duplicates(docs(spark, texts)).select("doc_id").collect()
    assert sorted(r[0] for r in left) == sorted(set(label.values()))


def test_vantage_trees_find_all_links():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    near = base[:1000].copy()
    for i in range(len(near)):
        for b in rng.choice(64, rng.integers(1, 6), replace=False):
            near[i] ^= np.uint64(1) << np.uint64(b)
    points = np.unique(np.concatenate([base, near]))
    trees = simhash.VantageTrees(points, len(points), 4, shard=200)
    index, shard = trees.shards(points)
    where = {}
    for i, s in zip(index.tolist(), shard.tolist()):
        where.setdefault(i, set()).add(s)
    r, c = np.nonzero(np.bitwise_count(points[:, None] ^ points[None]) <= 4)
    assert all(where[int(a)] & where[int(b)] for a, b in zip(r, c))


def test_large_shards_are_split_by_their_data(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 150, dtype=np.uint64)
    near = base[:100].copy()
    for i in range(len(near)):
        for b in rng.choice(64, rng.integers(1, 7), replace=False):
            near[i] ^= np.uint64(1) << np.uint64(b)
    points = np.unique(np.concatenate([base, near]))
    label = np.arange(len(points))
    linked = np.bitwise_count(points[:, None] ^ points[None]) <= 4
    for _ in points:
        label = np.array([label[row].min() for row in linked])
    fps = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    for most in (1 << 15, 5):
        got = {r["fp"]: r["group_fp"] for r in simhash.link_groups(fps, most=most, shard=64).collect()}
        groups = {}
        for k, p in zip(label.tolist(), points.view(np.int64).tolist()):
            groups.setdefault(k, set()).add(p)
        assert got == {p: min(g) for g in groups.values() if len(g) > 1 for p in g}


def test_simhash_of_a_long_text_and_equal_keys(spark):
    text = words(random.Random(4), 60_000)
    rows = [(1, text), (1, text), (2, text), (None, "other text of some words"), (3, "x")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 5 and [r["component_id"] for r in got if r["doc_id"] in (1, 2)] == [1, 1, 1]
    assert {r["fp"] & (1 << 64) - 1 for r in got if r["doc_id"] == 2} == {fingerprint_brute(text)}


def url_brute(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def test_url_rules(spark):
    urls = ["http://a.COM/x", "https://www.example.com/en/1?q=/fr/", "http://m.example.com/en/2#x", "http://xexample.com/en/", "http://z.net/es/3", "http://net/fr/", "http://z.net/en", "nothing", None, "", "http://", "http://a.b?x://c.com/y", "//x.com/", "http://a.com", "ftp://É.com/é?ü", "http://a\nb.net/es/\nq"]
    pages = spark.createDataFrame([(i, u, "h", 1, "x") for i, u in enumerate(urls)], "page_id long, url string, host string, n int, suffix string")
    got = {r["page_id"]: r for r in url_reputation.judge(pages, URL_RULES).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        host, path = url_brute(u)
        assert (got[i]["host"], got[i]["path"]) == (host, path)
        fit = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i]["rule"] == (max(fit)[1] if fit else None)
        assert got[i]["verdict"] == (max(fit)[2] if fit else got[i]["verdict"]) and got[i]["verdict"] in ("allow", "block")


def test_host_reputation_shrinks_and_blocks(spark):
    rows = [(f"bad.one.org", 1)] * 30 + [("good.one.org", 0)] * 40 + [("a.two.org", 0)] * 30 + [("rare.two.org", 1)] + [(None, 1), ("x.org", None)]
    outcomes = spark.createDataFrame(rows, "host string, bad int")
    pages = spark.createDataFrame([(1, "http://bad.one.org/"), (2, "http://good.one.org/"), (3, "http://rare.two.org/"), (4, "http://new.two.org/"), (5, "http://else.net/")], "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in url_reputation.judge(pages, [], outcomes).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow"}
    none = url_reputation.judge(pages, [], outcomes.limit(0)).collect()
    assert {r["verdict"] for r in none} == {"allow"} and len(none) == 5


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    rnd = random.Random(10)
    alphabet = [*"abcdeEst '  \n\t\r.,!0123é中😀 \x85\x1c​|<>", "<|endoftext|>", "'s", "'ll", "the", " the", "  "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(800)] + [None, "", "x" * 5000, " " * 300, "the cat" * 900]
    got = {r["doc_id"]: r for r in bpe.encode(clashing(docs(spark, texts)), tokenizer_path()).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(got[k]["token_ids"]), "<u4").tolist() == ids
        assert got[k]["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_decontamination(spark):
    rnd = random.Random(11)
    items = [words(rnd, rnd.choice([12, 30, 60])) for _ in range(20)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(90, None), (91, ""), (92, "short")], "item_id long, text string")
    texts = {k: words(rnd, 80) for k in range(30)}
    texts[3] += "\n" + items[5].upper().replace(" ", "  \n")
    edited = items[7].split()
    edited[len(edited) // 2] = edited[len(edited) // 2][::-1]
    texts[4] = words(rnd, 500) + " " + " ".join(edited) + " " + words(rnd, 500)
    texts[5] = items[2]
    texts |= {40: None, 41: ""}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(clashing(docs(spark, texts)), bench).collect()}
    assert got == {(3, 5), (4, 7), (5, 2)}
    small = decontaminate.contaminated(docs(spark, texts), bench, block_bytes=300).collect()
    assert {(r["doc_id"], r["item_id"]) for r in small} == got
    left = decontaminate.clean(docs(spark, texts), bench)
    assert left.count() == len(texts) - 3
    assert decontaminate.contaminated(docs(spark, texts), bench.limit(0)).count() == 0


def edit_brute(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_banded_alignment():
    rnd = random.Random(12)
    rows = []
    for _ in range(200):
        a = [rnd.choice(b"abcd") for _ in range(rnd.randint(5, 30))]
        b = list(a)
        for _ in range(rnd.randint(0, 3)):
            p = rnd.randrange(len(b))
            rnd.choice([lambda: b.pop(p), lambda: b.insert(p, 97), lambda: b.__setitem__(p, 100)])()
        pad = rnd.randint(4, 8)
        rows.append((a, [120] * pad + b + [120] * 3))
    wide = lambda xs: np.array([x + [0] * (max(map(len, xs)) - len(x)) for x in xs], np.uint8)
    limits = np.full(len(rows), 4)
    got = decontaminate.banded_distances(wide([a for a, _ in rows]), np.array([len(a) for a, _ in rows]), wide([b for _, b in rows]), 12, limits)
    assert got.tolist() == [min(edit_brute(a, b), 5) for a, b in rows]


FR = "le la les des une avec pour dans que qui est sont mais leur nous vous".split()
DE = "der die das und nicht mit auf ist sind aber ihr wir zwischen durch über".split()


def test_language(spark):
    rnd = random.Random(13)
    texts, lang = {}, {}
    for k in range(200):
        lang[k] = rnd.choice(["fr", "de"])
        texts[k] = " ".join(rnd.choice(FR if lang[k] == "fr" else DE) for _ in range(rnd.randint(3, 40)))
    texts |= {500: None, 501: "", 502: "123 456 !!", 503: "der die das und" * 4000}
    df = docs(spark, texts, lang)
    model = langid.fit(df.where("doc_id % 2 = 0"))
    got = {r["doc_id"]: r for r in langid.identify(clashing(df), model).collect()}
    right = [got[k]["lang_pred"] == lang[k] for k in range(1, 200, 2)]
    assert sum(right) / len(right) > 0.95
    for k in (500, 501, 502):
        assert got[k]["lang_pred"] == "und" and got[k]["score"] == 0 and not got[k]["accepted"]
    assert got[503]["lang_pred"] == "de" and all(0 <= r["score"] <= 1 for r in got.values())
    kept = langid.keep_identified(df, model)
    assert kept.columns == df.columns and kept.where("doc_id BETWEEN 500 AND 502").count() == 0
    nothing = langid.fit(df.limit(0))
    assert {r["lang_pred"] for r in langid.identify(df, nothing).collect()} == {"und"}


def test_quality_model(spark):
    rnd = random.Random(14)
    texts = {k: words(rnd, 60) if k % 3 else " ".join(w.upper() + "!!" for w in words(rnd, 60).split()) for k in range(240)}
    texts |= {900: None, 901: "", 902: "x" * 100_000}
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0) for k in range(240)] + [(1, 1, 1), (None, 1, 0), (5000, 0, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    held = zlib.crc32
    train = labels.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    model = quality_model.fit(docs(spark, texts), train)
    got = {r["doc_id"]: r["score"] for r in quality_model.score(clashing(docs(spark, texts)), model).collect()}
    test = [k for k in range(240) if held(str(k).encode()) % 3 == 1]
    assert sum((got[k] >= 0.5) == (k % 3 > 0) for k in test) / len(test) > 0.9
    assert len(got) == len(texts) and all(0 <= s <= 1 for s in got.values()) and got[900] == got[901]
    one = quality_model.fit(docs(spark, texts), train.where("quality = 1"))
    assert all(r["score"] > 0.5 for r in quality_model.score(docs(spark, texts), one).collect())


def test_language_scores_by_plain_sums(spark):
    rnd = random.Random(15)
    texts = [" ".join(rnd.choice(FR if k % 2 else DE) for _ in range(rnd.randint(3, 40))) for k in range(80)]
    lang = {k: "fr" if k % 2 else "de" for k in range(80)}
    model = langid.fit(docs(spark, texts, lang))
    got = {r["doc_id"]: r for r in langid.identify(docs(spark, texts), model).collect()}
    for k, text in enumerate(texts):
        z = [0.0] * len(model.languages)
        ids = langid.subwords(text, len(model.logits)).tolist()
        for i in ids:
            z = [a + b for a, b in zip(z, model.logits[i].tolist())]
        power = [math.exp(a / len(ids) / model.temperature) for a in z]
        best = max(range(len(z)), key=lambda j: power[j])
        assert got[k]["lang_pred"] == model.languages[best] and abs(got[k]["score"] - power[best] / sum(power)) < 1e-9
        assert got[k]["accepted"] == (got[k]["score"] >= model.accept)


def test_quality_scores_by_plain_sizes_and_several_labels(spark):
    rnd = random.Random(16)
    texts = [words(rnd, 60) if k % 2 else words(rnd, 60).upper() for k in range(80)] + ["", None, words(rnd, 30_000)]
    table = docs(spark, texts)
    labels = [(k, k % 2) for k in range(80)]
    model = quality_model.fit(table, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = {r["doc_id"]: r for r in quality_model.score(table, model).collect()}
    for k, text in enumerate(texts):
        data, sizes = (text or "").encode(), []
        for known in (model.good, model.bad):
            sizes.append(sum(len(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(known), write_content_size=False, write_dict_id=False).compress(data[at : at + quality_model.PART])) for at in range(0, len(data), quality_model.PART)))
        diff = (sizes[1] - sizes[0]) / sum(sizes) if data else 0.0
        assert abs(got[k]["size_difference"] - diff) < 0.02
        x = max(-30, min(30, model.slope * got[k]["size_difference"] + model.offset))
        assert abs(got[k]["score"] - 1 / (1 + math.exp(-x))) < 1e-9
    more = spark.createDataFrame([*labels, (1, 0), (3, 0), (3, 1), (5, 7), (None, 0)], "doc_id long, quality int")
    assert quality_model.fit(table, more) == model  # the greatest label of a key counts


def test_url_reputation_of_repeated_rows_and_long_urls(spark):
    long = "http://" + "a." * 50_000 + "net/" + "x/" * 100_000
    rows = [(1, "http://one.org/a"), (1, "http://one.org/a"), (1, "http://two.org"), (None, "http://one.org/a"), (2, long), (2, long + "?q")]
    outcomes = spark.createDataFrame([("one.org", 1)] * 50 + [("two.org", 0)] * 50, "host string, bad int")
    got = url_reputation.judge(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES, outcomes).collect()
    assert len(got) == 6 and sum(r["page_id"] is None for r in got) == 1
    assert sorted(r["verdict"] for r in got if r["host"] == "one.org") == ["block"] * 3 and [r["verdict"] for r in got if r["host"] == "two.org"] == ["allow"]
    assert {(r["host"], r["path"]) for r in got if r["page_id"] == 2} == {url_brute(long)}


def test_repetition_of_a_long_text(spark):
    base = [f"w{k}" for k in range(150_000)]
    text = " ".join(base + base[1_000:1_040] + ["end"])
    row = repetition.repetition(docs(spark, [text])).first()
    assert (row["n_words"], row["n_repeat_words"], row["n_covered"], row["longest_repeat"]) == (150_041, 80, 80, 40) and row["kept"]


def covered_brute(w, n):
    places = {}
    for i in range(len(w) - n + 1):
        places.setdefault(tuple(w[i : i + n]), []).append(i)
    return {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + n)}


def repeats_brute(t):
    w = re.findall(rb"[^\x20\x09-\x0D]+", t)
    covered = covered_brute(w, 8)
    lines, seen, dup = t.split(b"\n"), set(), 0
    for x in lines:
        if re.search(rb"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    best = 0
    for i in range(len(w)):
        for j in range(i + 1, len(w)):
            k = 0
            while j + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            best = max(best, k)
    return len(w), sum(len(x.decode()) for x in w), len(re.findall(rb"[#*$%&|<>]", t)), dup, len(covered), best


def test_repetition(spark):
    rnd = random.Random(15)
    texts = []
    for _ in range(150):
        k = rnd.choice([1, 2, 3, 12])
        texts.append("".join((rnd.choice(["a", "é", "b#", "cc"][:k]) if k < 12 else rnd.choice("abcdefghijkl")) + rnd.choice([" ", "\n", "  ", "\t", "\x1c", "\u00a0"]) for _ in range(rnd.randint(0, 50))))
    texts += [None, ""]
    got = {r["doc_id"]: r for r in repetition.repetition(clashing(docs(spark, texts))).collect()}
    for k, t in enumerate(texts):
        r, want = got[k], repeats_brute((t or "").encode())
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["longest_repeat"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0]) and not (r["base_failed"] and r["kept"])
        assert r["n_covered"] == len(covered_brute(re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()), 5))


def test_repetition_verdicts(spark):
    rnd = random.Random(25)
    plain = words(rnd, 300).split()
    five = " ".join(f"one two three four five {w}{i}" for i, w in enumerate(plain[:60]))
    block = " ".join(f"w{i}" for i in range(50))
    clean = " ".join(f"{w}{i}" for i, w in enumerate(plain))
    texts = [five, f"{block} {clean} {block}", clean, f"{clean} {' '.join(f'x{i}' for i in range(9000))} {block} and {block}"]
    got = {r["doc_id"]: r for r in repetition.repetition(docs(spark, texts)).collect()}
    assert [got[k]["base_failed"] for k in range(4)] == [False] * 4
    assert [got[k]["kept"] for k in range(4)] == [False, False, True, True]


@pytest.mark.parametrize("make", [lambda d: repetition.repetition(d), lambda d: simhash.near_duplicates(d), lambda d: line_templates.drop_recurring_lines(d), lambda d: bpe.encode(d, tokenizer_path())])
def test_empty_tables(spark, make):
    assert make(docs(spark, [])).count() == 0
