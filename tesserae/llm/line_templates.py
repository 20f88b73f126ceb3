"""Line dedup by a log-template tree.

A line goes down the tree by its token count and its leading tokens; tokens with a digit are variable fields and stand
as one mark. In a leaf, a token that most lines have at a place is constant, and the lines that agree with enough
constants belong to the leaf's template. Lines that no recurring template takes are split on by their best supported
token that is not constant, a fixed number of times, and each part is treated as a leaf again: so a leaf holds
several templates. Templates in many documents are dropped from all but the one with the smallest key, and so are
lines that recur as they are. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tesserae.functions.storage import cut, discard
from tesserae.llm.joins import spread

FIELD = "<*>"
SPACE = r"[ \t\r\f\x0B]"
_VARIABLE = r"(?<![^ \t\r\f\x0B\n])[^ \t\r\f\x0B\n0-9]*+[0-9][^ \t\r\f\x0B\n]*+"
#: Recurring lines of a row from which on they are looked up by parts.
MANY = 512


def _tokens(line: Column) -> Column:
    return F.split(line, " ", -1)


def normal_lines(text: Column, min_tokens: int) -> Column:
    """The text's lines with white space evened out and variable fields marked; below ``min_tokens`` as they are."""
    even = F.when(text.rlike(SPACE + "{2}|[\t\r\f\x0b]"), F.regexp_replace(text, SPACE + "+", " ")).otherwise(text)
    plain = F.split(even, "\n", -1)
    marked = F.split(F.regexp_replace(even, _VARIABLE, FIELD), "\n", -1)
    chosen = F.zip_with(plain, marked, lambda p, m: F.when(p == m, F.btrim(p)).when(F.size(_tokens(F.btrim(m))) >= min_tokens, F.btrim(m)).otherwise(F.btrim(p)))
    return F.when(text.rlike("[0-9]"), chosen).otherwise(F.transform(plain, lambda p: F.btrim(p)))


def _seen(rows: DataFrame, depth: int, min_tokens: int, long_chars: int) -> DataFrame:
    """``row, key, line, leaf, line_hash, long`` of the distinct normal lines with a letter of each row."""
    numbered = rows.withColumn("row", F.monotonically_increasing_id())  # below the explode: one number for each row
    lines = numbered.select("row", "key", F.explode(F.array_distinct(normal_lines(F.col("text"), min_tokens))).alias("line"))
    tokens = _tokens(F.col("line"))
    leaf = F.when(F.size(tokens) >= min_tokens, F.xxhash64(F.size(tokens), F.slice(tokens, 1, depth))).otherwise(F.xxhash64(F.lit("short"), F.lit(0), "line"))
    long = (F.size(tokens) >= min_tokens) & (F.length("line") >= long_chars)
    return lines.where(F.col("line").rlike(r"\p{L}")).select("row", "key", "line", leaf.alias("leaf"), F.xxhash64("line").alias("line_hash"), long.alias("long"))


def _templates(members: DataFrame, seen: DataFrame, depth: int, min_docs: int, constant: float, similar: float) -> tuple[DataFrame, DataFrame]:
    """Lines ``leaf, line_hash, least`` of the recurring templates of these nodes, and the other lines, one level down.

    ``members`` has ``node, leaf, line_hash, n, tokens``: the tokens after the leading ones, and the rows with the line.
    """
    places = members.select("node", "leaf", "line_hash", "n", F.size("tokens").alias("size"), F.posexplode("tokens").alias("place", "token"))
    counted = places.groupBy("node", "place", "token").agg(F.sum("n").alias("support"))
    top = counted.groupBy("node", "place").agg(F.max(F.struct("support", "token")).alias("top"), F.sum("support").alias("total"))
    fixed = top.where(F.col("top.support") >= F.col("total") * constant).select("node", "place", F.col("top.token").alias("token"), F.lit(True).alias("fixed"))
    known = counted.where(F.col("support") >= min_docs).join(fixed, ["node", "place", "token"], "left")
    branch = F.struct("support", (-F.col("place")).alias("place"), "token")
    judged = cut(
        spread(places, known, ["node", "place", "token"])
        .groupBy("node", "leaf", "line_hash", "size")
        .agg(F.count("fixed").alias("agree"), F.max(F.when(F.col("fixed").isNull(), branch)).alias("branch"))
    )
    agreeing = judged.where(F.col("agree") >= F.col("size") * similar).select("node", "leaf", "line_hash")
    in_rows = seen.select("row", "key", "leaf", "line_hash").join(agreeing, ["leaf", "line_hash"])
    recurring = in_rows.groupBy("node").agg(F.count_distinct("row").alias("rows"), F.min("key").alias("least")).where(F.col("rows") >= min_docs)
    covered = cut(spread(agreeing, recurring.select("node", "least"), ["node"]).select("leaf", "line_hash", "least"))
    rest = judged.where("branch IS NOT NULL").join(covered, ["leaf", "line_hash"], "left_anti")
    down = rest.select("leaf", "line_hash", F.xxhash64("node", "branch").alias("node"))
    return covered, members.drop("node").join(down, ["leaf", "line_hash"]).select("node", "leaf", "line_hash", "n", "tokens")


def _worth(members: DataFrame, min_docs: int) -> DataFrame:
    """The members of nodes in which a template of several lines can recur."""
    nodes = members.groupBy("node").agg(F.sum("n").alias("total"), F.count("*").alias("lines")).where((F.col("total") >= min_docs) & (F.col("lines") > 1))
    return spread(members, nodes.select("node"), ["node"], "left_semi")


def recurring_lines(seen: DataFrame, depth: int, min_tokens: int, min_docs: int, min_docs_long: int, constant: float, similar: float, levels: int) -> DataFrame:
    """``leaf, line_hash, least`` of the lines that recur by themselves or by a template, and the smallest key with it."""
    by_line = cut(seen.groupBy("leaf", "line_hash").agg(F.count("*").alias("n"), F.min("key").alias("least"), F.first("long").alias("long")))
    found = by_line.where((F.col("n") >= min_docs) | (F.col("long") & (F.col("n") >= min_docs_long))).select("leaf", "line_hash", "least")
    wanted = _worth(by_line.select(F.col("leaf").alias("node"), "leaf", "line_hash", "n"), min_docs)
    leaves = cut(wanted.select("leaf").distinct())
    inside = spread(seen, leaves, ["leaf"], "left_semi").where(F.size(_tokens(F.col("line"))) > depth)
    lines = inside.groupBy("leaf", "line_hash").agg(F.first("line").alias("line"), F.count("*").alias("n"))
    tokens = F.slice(_tokens(F.col("line")), depth + 1, F.size(_tokens(F.col("line"))))
    members = cut(lines.select(F.col("leaf").alias("node"), "leaf", "line_hash", "n", tokens.alias("tokens")))
    for level in range(levels + 1):
        covered, down = _templates(members, seen, depth, min_docs, constant, similar)
        found = found.union(covered)
        if level < levels:
            members = cut(_worth(down, min_docs))
    return found.groupBy("leaf", "line_hash").agg(F.min("least").alias("least"))


def drop_recurring_lines(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    depth: int = 3,
    min_tokens: int = 3,
    min_docs: int = 5,
    min_docs_long: int = 2,
    long_chars: int = 60,
    constant: float = 0.6,
    similar: float = 0.75,
    levels: int = 2,
    also: tuple[str, ...] = (),
) -> DataFrame:
    """``key, text, n_lines, n_dropped`` of every row: ``text`` without the lines that recur.

    A line recurs if ``min_docs`` rows have it (tokens with digits standing for each other from ``min_tokens`` tokens
    on), if it has ``long_chars`` characters and ``min_docs_long`` rows have it, or if its template is in ``min_docs``
    rows. Templates: of the lines with equal token count and ``depth`` equal leading tokens, those of whose other
    tokens the share ``similar`` is constant; constant is what the share ``constant`` of these lines (each as often
    as it has rows) has at its place. Lines that no recurring template takes are split by their best supported
    token that is not constant (ties: the first place, then the greatest token), ``levels`` times. Lines without a
    letter are layout and stay. Rows with the smallest key that has a line or its template keep theirs. Null texts
    count as empty (one empty line); null keys never keep a recurring line. Rows with equal keys lose the same lines
    but count as rows each. Of the other columns those named in ``also`` are kept.
    """
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.struct(*(F.col(c) for c in also)).alias("rest") if also else F.lit(None).alias("rest"),
    )
    seen = cut(_seen(rows, depth, min_tokens, long_chars))
    recurring = recurring_lines(seen, depth, min_tokens, min_docs, min_docs_long, constant, similar, levels)
    gone = spread(seen.select("key", "leaf", "line_hash"), recurring, ["leaf", "line_hash"]).where(~F.col("key").eqNullSafe(F.col("least")))
    hits = cut(gone.groupBy(F.col("key").alias("hit_key")).agg(F.collect_set("line_hash").alias("gone")))
    discard([seen])
    found = rows.join(hits.hint("shuffle_hash"), F.col("key").eqNullSafe(F.col("hit_key")), "left")
    raw = F.split("text", "\n", -1)
    hashes = F.transform(normal_lines(F.col("text"), min_tokens), lambda x: F.xxhash64(x))
    by_part = F.transform(F.sequence(F.lit(0), F.lit(255)), lambda b: F.filter("gone", lambda h: F.pmod(h, F.lit(256)) == b))
    found = found.withColumn("by_part", F.when(F.size("gone") > MANY, by_part))
    is_gone = lambda h: F.array_contains(F.when(F.col("by_part").isNull(), F.col("gone")).otherwise(F.get("by_part", F.pmod(h, F.lit(256)).cast("int"))), h)
    kept = F.filter(F.zip_with(raw, hashes, lambda line, h: F.struct(line.alias("line"), h.alias("h"))), lambda x: ~is_gone(x["h"]))
    lines = F.when(F.col("gone").isNull(), raw).otherwise(F.transform(kept, lambda x: x["line"]))
    out = found.select("key", F.size(raw).alias("n_lines"), lines.alias("lines"), "rest")
    return out.select(
        F.col("key").alias(key),
        F.array_join("lines", "\n").alias("text"),
        F.col("n_lines").cast("long"),
        (F.col("n_lines") - F.size("lines")).cast("long").alias("n_dropped"),
        *([F.col(f"rest.`{c}`") for c in also]),
    )
