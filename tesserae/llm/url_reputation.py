"""URL filters: empirical-Bayes host reputation with rules that come before it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tesserae.functions.storage import cut
from tesserae.llm.joins import spread


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest ``(verdict, host, path)`` rule that fits, as a struct ``rule, verdict``; null if none does.

    A rule fits its host and all subdomains if the path starts with the rule's. Equally long rules: the first listed.
    """
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for _, h, p in ranked]
    picks = [F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for v, h, p in ranked]
    return reduce(lambda rest, x: F.when(x[0], x[1]).otherwise(rest), reversed(list(zip(fits, picks))), F.lit(None).cast("struct<rule:string,verdict:string>"))


def _strength(counts: DataFrame, parent: str, weakest: float = 1.0, strongest: float = 200.0) -> float:
    """Pseudo-counts of a level's beta prior: method of moments over the spread of its groups about their parent.

    ``counts`` has ``n, bad`` of each group and of its parent (``parent_n, parent_bad``).
    """
    p = F.col("parent_bad") / F.col("parent_n")
    row = counts.select(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - p, 2)).alias("spread"),
        F.sum(p * (1 - p)).alias("binomial"),
        F.sum(F.col("n") * p * (1 - p)).alias("weighted"),
        F.count("*").alias("groups"),
    ).first()
    if not row["groups"] or not row["weighted"]:
        return strongest
    extra = (row["spread"] - row["binomial"]) / max(row["weighted"] - row["binomial"], 1e-9)
    if extra <= 0:
        return strongest
    return float(min(strongest, max(weakest, 1 / extra - 1)))


#: Public suffixes of more than one label; a parameter of ``judge``. Others are the last label.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "com.br", "com.cn", "co.in", "co.kr", "co.za", "com.mx", "com.tr")


def host_levels(host: Column, suffixes: Sequence[str] = SUFFIXES) -> tuple[Column, Column]:
    """Suffix and registered domain (one label more) of a host, without user and port; an IP address is both itself."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")
    many = "".join(s.replace(".", r"\.") + "|" for s in suffixes)
    suffix = F.regexp_extract(name, rf"(?:^|\.)({many}[^.]*)$", 1)
    rest = F.substring(name, F.lit(1), F.length(name) - F.length(suffix) - 1)
    domain = F.when(F.length(name) > F.length(suffix), F.concat_ws(".", F.regexp_extract(rest, r"[^.]*$", 0), suffix)).otherwise(suffix)
    ip = name.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    return F.when(ip, name).otherwise(suffix), F.when(ip, name).otherwise(domain)


def host_reputation(outcomes: DataFrame, z: float = 1.0, suffixes: Sequence[str] = SUFFIXES) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """Posterior share of bad pages of every suffix, registered domain and host.

    ``outcomes`` has ``host`` and ``bad`` (0 or 1; null rows do not count). Each level's counts are shrunk towards its
    parent's posterior mean: all pages, then suffix, registered domain, host. Returns tables
    by suffix, domain and host with ``mean`` and ``bound`` (mean less ``z`` posterior standard deviations), and the
    overall values for what is in none of them. A level's strength is estimated from the spread of its groups.
    """
    suffix, domain = host_levels(F.col("host"), suffixes)
    seen = cut(
        outcomes.where(F.col("bad").isNotNull() & F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
        .withColumns({"suffix": suffix, "domain": domain})
    )
    total = seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    mean = (total["bad"] + 1) / (total["n"] + 2)
    by_suffix = seen.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = seen.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    k_suffix = _strength(by_suffix.withColumns({"parent_n": F.lit(float(max(1, total["n"]))), "parent_bad": F.lit(float(total["bad"]))}), "all")
    above = lambda t, key: t.select(key, F.col("n").alias("parent_n"), F.col("bad").alias("parent_bad"))
    k_domain = _strength(spread(domains, above(by_suffix, "suffix"), ["suffix"]), "suffix")
    k_host = _strength(seen.join(above(domains, "domain"), "domain"), "domain")

    def posterior(t: DataFrame, prior: Column, k: float) -> DataFrame:
        a, b = F.col("bad") + prior * k, F.col("n") - F.col("bad") + (1 - prior) * k
        m = a / (a + b)
        return t.withColumn("mean", m).withColumn("bound", m - z * F.sqrt(m * (1 - m) / (a + b + 1)))

    by_suffix = posterior(by_suffix, F.lit(mean), k_suffix)
    prior = lambda t, key: t.select(key, F.col("mean").alias("prior"))
    domains = posterior(spread(domains, prior(by_suffix, "suffix"), ["suffix"]), F.col("prior"), k_domain)
    hosts = posterior(seen.join(prior(domains, "domain"), "domain"), F.col("prior"), k_host)
    return by_suffix, domains, hosts, {"mean": mean, "bound": mean - z * (mean * (1 - mean) / (total["n"] + 3)) ** 0.5}


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    outcomes: DataFrame | None = None,
    url: str = "url",
    key: str = "page_id",
    block_at: float = 0.5,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """``key, host, path, rule, verdict, bound`` of every row.

    The longest fitting rule decides; else a page is blocked if the posterior lower bound of its host's share of bad
    pages (of its domain's, suffix's or all pages' if the host has no labelled page) is over ``block_at``.
    ``outcomes`` (``host, bad``) defaults to the rules' own verdicts on these pages. Null URLs and URLs without
    ``://`` have an empty host and path; without any outcome the bound is that of an even prior and nothing is
    blocked. Repeated rows are each judged; other columns are left out.
    """
    rows = pages.select(F.col(key).alias("page_key"), F.col(url).cast("string").alias("u"))
    host, path = url_parts(F.col("u"))
    parts = rows.select("page_key", host.alias("host"), path.alias("path"))
    parts = parts.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    if outcomes is None:
        outcomes = parts.where("found IS NOT NULL").select("host", (F.col("found.verdict") == "block").cast("int").alias("bad"))
    by_suffix, domains, hosts, overall = host_reputation(outcomes, suffixes=suffixes)
    suffix, domain = host_levels(F.col("host"), suffixes)
    known = parts.select("host").distinct().withColumns({"suffix": suffix, "domain": domain})
    placed = known.join(hosts.select("host", F.col("bound").alias("by_host")), "host", "left").join(domains.select("domain", F.col("bound").alias("by_domain")), "domain", "left")
    best = spread(placed, by_suffix.select("suffix", F.col("bound").alias("by_suffix")), ["suffix"], "left").select(
        "host", F.coalesce("by_host", "by_domain", "by_suffix", F.lit(overall["bound"])).alias("bound")
    )
    return spread(parts, best, ["host"], "left").select(
        F.col("page_key").alias(key),
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("bound") > block_at, "block").otherwise("allow")).alias("verdict"),
        "bound",
    )
