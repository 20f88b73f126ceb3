"""Queries over runs, splits and timers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tesserae.operators import runs, splits
from tesserae.plans.base import query, r6
from tesserae.sources.adapters import cte, load, table

_R = cte("runs")
_M = ["jaccard", "recall", "loss:lower"]
_BAD = "(jaccard = 0 OR recall = 0 OR loss = 0)"
_HARM = "3 / (1 / nullif(jaccard, 0) + 1 / nullif(recall, 0) + loss)"
_GEOM = "power(jaccard * recall * (1 / loss), 1.0 / 3)"


@query(
    f"{_R} SELECT run, round(coalesce(avg(CASE WHEN NOT {_BAD} THEN {_HARM} END), 0.0), 6) AS harmonic, round(coalesce(avg(CASE WHEN NOT {_BAD} THEN {_GEOM} END), 0.0), 6) AS geometric, "
    f"round(avg((jaccard + recall + 1 / loss) / 3), 6) AS arithmetic, round(avg(least(jaccard, recall, 1 / loss)), 6) AS lowest, bool_or({_BAD}) AS is_unstable FROM runs GROUP BY run"
)
def g16_run_scores(spark, sf_dir):
    r = load(spark, sf_dir, "runs")
    out = None
    for name, how in (("harmonic", "harmonic"), ("geometric", "geometric"), ("arithmetic", "arithmetic"), ("lowest", "min")):
        part = runs.group_score(r, _M, how).select("run", r6("score").alias(name), *(["is_unstable"] if name == "harmonic" else []))
        out = part if out is None else out.join(part, "run")
    return out


@query(f"{_R} SELECT trial, round(CASE WHEN {_BAD} THEN 0.0 ELSE {_HARM} END, 6) AS harmonic, round(least(jaccard, recall, 1 / loss), 6) AS lowest, round(jaccard, 6) AS single, {_BAD} AS is_unstable FROM runs")
def g17_g18_single_runs(spark, sf_dir):
    r = load(spark, sf_dir, "runs")
    return r.select("trial", r6(runs.run_score(_M, "harmonic")).alias("harmonic"), r6(runs.run_score(_M, "min")).alias("lowest"), r6(runs.run_score(["jaccard"], "min")).alias("single"), runs.unstable(_M).alias("is_unstable"))


_G = f"g AS (SELECT run, coalesce(avg(CASE WHEN NOT {_BAD} THEN {_HARM} END), 0.0) AS score, bool_or({_BAD}) AS is_unstable FROM runs GROUP BY run)"


@query(f"{_R}, {_G} SELECT r.trial, r.run, round(g.score, 6) AS score, g.is_unstable FROM runs r JOIN g ON g.run = r.run")
def g19_fold_summary(spark, sf_dir):
    s = runs.with_summary(load(spark, sf_dir, "runs"), _M, "harmonic")
    return s.select("trial", "run", r6("score").alias("score"), "is_unstable")


@query(f"{_R}, x AS (SELECT * FROM runs WHERE NOT {_BAD}), g AS (SELECT run, avg({_HARM}) AS score FROM x GROUP BY run) SELECT run, round(score, 6) AS score FROM g ORDER BY score DESC, run LIMIT 1")
def g20_best_trial(spark, sf_dir):
    r = load(spark, sf_dir, "runs").where(~runs.unstable(_M))
    return runs.best(runs.group_score(r, _M, "harmonic")).withColumn("score", r6("score"))


@query("SELECT event_type AS step, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, count(value) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def g21_step_timing(spark, sf_dir):
    t = table(spark, sf_dir, "events").select(F.col("event_type").alias("step"), F.col("value").alias("seconds"))
    return runs.timer_summary(t).select("step", r6("mean").alias("mean"), r6("std").alias("std"), "n", r6("total", 4).alias("total"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'tax' AS step, l_tax AS seconds FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'discount', l_discount FROM lineitem")
def g21_long_timers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_tax").alias("tax"), F.col("l_discount").alias("discount"))
    return runs.long_form(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["tax", "discount"])


@query(
    "WITH m AS (SELECT l_suppkey AS sample_id, l_discount < 0.05 AS is_empty, l_orderkey % 1000 AS xmin, l_orderkey % 1000 + 1 + l_linenumber AS xmax, l_partkey % 1000 AS ymin, l_partkey % 1000 + 2 AS ymax FROM lineitem), a AS (SELECT *, (xmax - xmin) * (ymax - ymin) AS a FROM m) "
    "SELECT sample_id, CAST(sum(CASE WHEN NOT is_empty THEN 1 ELSE 0 END) AS BIGINT) AS non_empty, round(sum(a * (xmin + xmax) / 2) / sum(a), 4) AS cx, round(sum(a * (ymin + ymax) / 2) / sum(a), 4) AS cy FROM a GROUP BY sample_id"
)
def g22_dissolve_samples(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    m = li.select(F.col("l_suppkey").alias("sample_id"), (F.col("l_discount") < 0.05).alias("is_empty"), (F.col("l_orderkey") % 1000).alias("xmin"), (F.col("l_orderkey") % 1000 + 1 + F.col("l_linenumber")).alias("xmax"), (F.col("l_partkey") % 1000).alias("ymin"), (F.col("l_partkey") % 1000 + 2).alias("ymax"))
    d = splits.dissolve(m)
    return d.withColumns({"cx": r6("cx", 4), "cy": r6("cy", 4)})


_P = cte("patches")


@query(f"{_P} SELECT region, CAST(sum(CASE WHEN is_empty THEN 1 ELSE 0 END) AS BIGINT) AS empty_patches, CAST(sum(CASE WHEN is_empty THEN 0 ELSE 1 END) AS BIGINT) AS non_empty_patches FROM patches GROUP BY region")
def g23_patches_by_region(spark, sf_dir):
    return splits.by_region(load(spark, sf_dir, "patches"))


@query(f"{_P} SELECT CASE WHEN region IN (2, 5) THEN 'test' ELSE 'train' END AS part, CAST(sum(CASE WHEN is_empty THEN 0 ELSE 1 END) AS BIGINT) AS positives, CAST(sum(CASE WHEN is_empty THEN 1 ELSE 0 END) AS BIGINT) AS negatives, count(*) AS total, count(DISTINCT region) AS regions, count(DISTINCT sample_id) AS samples FROM patches GROUP BY 1")
def g24_h9_split_statistics(spark, sf_dir):
    return splits.split_statistics(splits.split_by_value(load(spark, sf_dir, "patches"), "region", [2, 5]))


@query(f"{_P} SELECT CASE WHEN sample_id IN (1, 2, 3) THEN 'test' ELSE 'train' END AS part, count(*) AS n FROM patches GROUP BY 1")
def h9_split_by_sample(spark, sf_dir):
    return splits.split_by_value(load(spark, sf_dir, "patches"), "sample_id", [1, 2, 3]).groupBy("part").agg(F.count("*").alias("n"))


@query("SELECT part, n FROM (SELECT 'train' AS part, CAST(round_even(count(*) * 0.7, 0) AS BIGINT) AS n FROM orders UNION ALL SELECT 'test', count(*) - CAST(round_even(count(*) * 0.7, 0) AS BIGINT) FROM orders) s")
def h9_random_split(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.split_random(o, "o_orderkey", 0.7, F.col("o_orderstatus") == "F").groupBy("part").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, part FROM orders CROSS JOIN (SELECT unnest(['train', 'test']) AS part) p")
def h9_no_split(spark, sf_dir):
    return splits.no_split(table(spark, sf_dir, "orders").select("o_orderkey"))


@query("SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_orderkey) - 1 AS INT) AS fold FROM orders")
def h10_contiguous_folds(spark, sf_dir):
    return splits.contiguous_folds(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 7)


@query("SELECT o_orderstatus, CAST(f AS INT) AS fold, count(*) // 5 + CASE WHEN f < count(*) % 5 THEN 1 ELSE 0 END AS n FROM orders CROSS JOIN range(0, 5) r(f) GROUP BY o_orderstatus, f")
def h10_stratified_folds(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified_folds(o, "o_orderkey", "o_orderstatus", 5).groupBy("o_orderstatus", "fold").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, 5 AS folds FROM orders")
def h10_shuffled_folds(spark, sf_dir):
    o = splits.shuffled_folds(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 5)
    return o.agg(F.count("*").alias("n"), F.count_distinct("fold").cast("int").alias("folds"))


@query("SELECT c_nationkey, 1 AS folds, count(*) AS n FROM customer GROUP BY c_nationkey")
def h10_region_folds(spark, sf_dir):
    c = splits.group_folds(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", 5)
    return c.groupBy("c_nationkey").agg(F.count_distinct("fold").cast("int").alias("folds"), F.count("*").alias("n"))


@query(
    "WITH g AS (SELECT c_custkey % 50 AS region, sum(CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END) AS w FROM customer GROUP BY 1), k AS (SELECT w, row_number() OVER (ORDER BY w DESC) - 1 AS k FROM g) "
    "SELECT CAST(k % 5 AS INT) AS fold, count(*) AS regions, CAST(sum(w) AS BIGINT) AS positives FROM k GROUP BY 1"
)
def h10_region_stratified_folds(spark, sf_dir):
    """Whole regions, dealt by how many positives they have, so that folds have nearly as many."""
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") % 50).alias("region"), (F.col("c_acctbal") > 0).alias("positive"))
    c = splits.group_folds(c, "region", 5, stratum=F.col("positive"))
    return c.groupBy("fold").agg(F.count_distinct("region").alias("regions"), F.count_if("positive").alias("positives"))


@query("SELECT least(count(*), 100) AS n FROM orders")
def h11_subsample(spark, sf_dir):
    return splits.subsample(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 100).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders")
def h12_select_bands(spark, sf_dir):
    return splits.select_bands(table(spark, sf_dir, "orders"), ["o_orderkey"], ["o_totalprice"])


@query("SELECT p_partkey, p_size FROM part")
def g28_drop_empty_columns(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", F.when(F.col("p_size") < 0, 1).alias("never"))
    return runs.drop_empty_columns(p)
