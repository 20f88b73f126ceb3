"""The registered queries of this folder: whole tables, production parameters, digest columns of the contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tesserae.llm import bottom_k, bpe, decontaminate, langid, line_templates, periodic_runs, pii, quality_model, ranked_search, repetition, simhash, suffix_dedup, url_reputation

#: The rules of the URL query, ``(verdict, host, path)``.
URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _held_out(key: str, of: int, part: int):
    """Whether a row's key falls into a part; a null key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % of == part, F.lit(False))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.sanitise(table(spark, sf_dir, "documents"))
    base = [f"spans_{k}" for k in pii.KINDS]
    return found.select(
        "doc_id",
        *(F.size(f"spans_{k}").cast("long").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(F.array_join(pii.joined(*base), ","), 256).alias("base_sha256"),
        F.array_join(pii.joined(*base, *(f"spans_{k}" for k in pii.ADDED), "spans_term"), ",").alias("spans"),
        F.size("spans_secret").cast("long").alias("n_secret"),
        F.size("spans_term").cast("long").alias("n_term"),
        F.sha2("sanitised", 256).alias("sanitised_sha256"),
    )


def op2_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_templates.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the rules' own verdicts on the pages they decide; no other table has outcomes of pages."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_reputation.judge(pages, URL_RULES).withColumn("bound", F.round("bound", 6))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return found.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_regions", "edits")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = _held_out("doc_id", 4, 2)
    model = langid.fit(docs.where(~held))
    return langid.identify(docs, model).withColumn("held_out", held).select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = _held_out("doc_id", 3, 1)
    model = quality_model.fit(docs, table(spark, sf_dir, "labels").where(~held))
    found = quality_model.score(docs, model)
    return found.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered", "longest_repeat")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """The query's own rule: of documents whose key has a CRC that ends in 0, the words from one place on repeat."""
    h, n = F.crc32(F.col("doc_id").cast("string")), F.col("n")
    g = F.floor(h / 10)
    a = F.pmod(g, n)
    p = F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)) + 1
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.filter(F.split("text", "[ \t-\r]+"), lambda w: w != "")).alias("words"))
    sized = chosen.withColumn("n", F.size("words")).withColumns({"a": F.when(n > 0, a), "p": F.when(n > 0, p)})
    word = lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + F.pmod(i - F.col("a"), F.col("p"))).cast("int"))
    planted = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")
    return sized.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_with_planted_periods(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottom_k.near_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (op1_pii, op2_line_templates, op3_suffix_dedup, op4_simhash, op5_url_reputation, op6_bpe, op7_decontaminate, op8_language, op9_quality_model, op10_repetition, op11_ranked_search, op12_periodic_runs, op13_bottom_k)
    return {f.__name__: f for f in made}


def _strength_sql(name: str, groups: str) -> str:
    """A level's prior strength; ``groups`` selects n, bad and the parent's pn, pb."""
    return (
        f"{name} AS (SELECT CASE WHEN coalesce(weighted, 0) = 0 THEN 200.0 WHEN (spread - binomial) / greatest(weighted - binomial, 1e-9) <= 0 THEN 200.0 ELSE least(200.0, greatest(1.0, greatest(weighted - binomial, 1e-9) / (spread - binomial) - 1)) END AS k "
        f"FROM (SELECT sum(n * power(bad / n - pb / pn, 2)) AS spread, sum(pb / pn * (1 - pb / pn)) AS binomial, sum(n * (pb / pn) * (1 - pb / pn)) AS weighted FROM ({groups}) g) m)"
    )


def _posterior_sql(name: str, columns: str, source: str, prior: str, k: str) -> str:
    return f"{name} AS (SELECT *, m - sqrt(m * (1 - m) / (n + k + 1)) AS bound FROM (SELECT {columns}, t.n, t.bad, {k}.k AS k, (t.bad + {prior} * {k}.k) / (t.n + {k}.k) AS m FROM {source} CROSS JOIN {k}) p)"


def _url_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ranked = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    chain = lambda pick: "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{pick(v, h + p)}'" for v, h, p in ranked) + " END"
    many = "".join(x.replace(".", "\\.") + "|" for x in url_reputation.SUFFIXES)
    above = lambda t, key, up: f"SELECT t.n, t.bad, u.n AS pn, u.bad AS pb FROM {t} t JOIN {up} u ON u.{key} = t.{key}"
    return (
        "WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages), "
        f"h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{upper.lower()}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r), "
        f"f0 AS (SELECT *, {chain(lambda v, r: r)} AS rule, {chain(lambda v, r: v)} AS ruled, regexp_replace(regexp_replace(host, '^.*@', ''), '\\.?(:[0-9]*)?$', '') AS name FROM h), "
        f"e AS (SELECT *, regexp_extract(name, '(?:^|\\.)({many}[^.]*)$', 1) AS tail, regexp_matches(name, '^[0-9]+(\\.[0-9]+){{3}}$') AS ip FROM f0), "
        "f AS (SELECT page_id, host, path, rule, ruled, CASE WHEN ip THEN name ELSE tail END AS suffix, CASE WHEN ip THEN name WHEN length(name) > length(tail) THEN regexp_extract(substr(name, 1, length(name) - length(tail) - 1), '[^.]*$') || '.' || tail ELSE tail END AS domain FROM e), "
        "hosts AS (SELECT host, domain, suffix, count(*) AS n, sum(CASE WHEN ruled = 'block' THEN 1 ELSE 0 END) AS bad FROM f WHERE ruled IS NOT NULL GROUP BY host, domain, suffix), "
        "domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix), suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY suffix), "
        "total AS (SELECT coalesce(sum(n), 0) AS n, coalesce(sum(bad), 0) AS bad FROM hosts), "
        + ", ".join(
            [
                _strength_sql("ks", "SELECT s.n, s.bad, greatest(t.n, 1) AS pn, t.bad AS pb FROM suffixes s CROSS JOIN total t"),
                _strength_sql("kd", above("domains", "suffix", "suffixes")),
                _strength_sql("kh", above("hosts", "domain", "domains")),
                _posterior_sql("ps", "t.suffix", "suffixes t CROSS JOIN total a", "(a.bad + 1) / (a.n + 2)", "ks"),
                _posterior_sql("pd", "t.domain", "domains t JOIN ps u ON u.suffix = t.suffix", "u.m", "kd"),
                _posterior_sql("ph", "t.host", "hosts t JOIN pd u ON u.domain = t.domain", "u.m", "kh"),
            ]
        )
        + ", j AS (SELECT f.page_id, f.host, f.path, f.rule, f.ruled, coalesce(ph.bound, pd.bound, ps.bound, (t.bad + 1) / (t.n + 2) - sqrt((t.bad + 1) / (t.n + 2) * (1 - (t.bad + 1) / (t.n + 2)) / (t.n + 3))) AS bound "
        "FROM f LEFT JOIN ph ON ph.host = f.host LEFT JOIN pd ON pd.domain = f.domain LEFT JOIN ps ON ps.suffix = f.suffix CROSS JOIN total t) "
        "SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict, round(bound, 6) AS bound FROM j"
    )


def _search_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    split = f"regexp_extract_all(translate(text, '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return (
        f"WITH t AS (SELECT doc_id, unnest({split}) AS term FROM documents), tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY doc_id, term), "
        "n AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id), g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n), "
        "w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN g GROUP BY term, docs), "
        "m AS (SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM n CROSS JOIN g), "
        f"q AS (SELECT item_id, term, count(*) AS c FROM (SELECT item_id, unnest({split}) AS term FROM benchmark) x GROUP BY item_id, term), "
        "s AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id), "
        "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0) "
        "SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"
    )


def _similar_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    split = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x20\\x09-\\x0D]+')"
    return (
        f"WITH RECURSIVE w AS (SELECT doc_id, {split} AS w FROM documents), "
        "s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] for i in range(1, len(w) - 2)] END) AS g FROM w), "
        "n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), "
        "p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id), "
        "e AS MATERIALIZED (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 80 * (x.n + y.n - c)), "
        "r AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, e.v FROM r JOIN e ON e.u = r.other), "
        "m AS (SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id) "
        "SELECT m.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, m.doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)"
    )


def oracle_sql() -> dict[str, str]:
    return {"op5_url_reputation": _url_sql(), "op11_ranked_search": _search_sql(), "op13_bottom_k": _similar_sql()}
