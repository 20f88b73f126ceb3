"""Personal data: patterns with checks, and terms that give a protected entity away.

An entity is the value of a match. A term that stands near it is scored by how much of the entity's information
it reveals: pointwise mutual information over the entity's information content, both from row counts over the whole
corpus (1: whoever reads the term knows the entity). Terms over a threshold are removed, those over a lower one are
replaced by what kind of entity they point at. Beside the base kinds, long tokens whose characters carry as much
information as random ones are secrets. Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from tesserae.functions.storage import cut

#: The kinds in the order of results, and their patterns. The quantifiers never give back what they
#: took and a match starts at the start of a run, so that long texts cost linear time; what matches is the same.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
#: Kinds that the method adds: tokens of letters and digits with many different characters.
ADDED = {"secret": r"(?<![A-Za-z0-9+=_-])[A-Za-z0-9+=_-]{20,}+"}
_DISTINCT = 10
ALL = (*KINDS, *ADDED)
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
TERM = r"\p{L}+"
#: Terms that are sent whole to every executor at most; beyond that the joins shuffle.
BROADCAST_TERMS = 50_000
#: Code points of the pieces from which a text is put together again.
PIECE = 1024
#: Terms of a row from which on they are looked up by halving.
MANY = 64


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = _digits(value)
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        x = F.substring(digits, n - i + 1, F.lit(1)).cast("int") * (2 - i % 2)
        return total + F.when(x > 9, x - 9).otherwise(x)

    return F.when(n.between(16, 19), F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0).otherwise(False)


def _passes(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike("^" + r"\.".join([_BYTE] * 4) + "$")
    if kind == "card":
        return _luhn(value)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    if kind == "secret":
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= _DISTINCT)
    return F.lit(True)


def _maybe(kind: str, text: Column) -> Column:
    """Whether a text can match at all, found out cheaply."""
    return {"email": text.contains("@"), "phone": text.contains("+"), **{k: text.rlike(p) for k, p in ADDED.items()}}.get(kind, text.rlike("[0-9]"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; a column would be put into its place wherever it is named."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def _running(values: Column, step: Callable[[Column, Column], Column] = add, part: int = 128) -> Column:
    """For each of some numbers (0 at least) what ``step``, an associative function, makes of those before it: their sum.

    Parts are taken together first, which keeps the work near linear.
    """
    whole = lambda xs: F.aggregate(xs, F.lit(0), step)
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def sums(parts: Column) -> Column:
        starts = F.aggregate(F.transform(parts, lambda x: whole(x)), begin, lambda s, v: F.struct(step(s["at"], v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])
        return F.flatten(F.zip_with(parts, starts, lambda xs, start: F.transform(xs, lambda _, i: step(start, whole(F.slice(xs, F.lit(1), i))))))

    return F.when(F.size(values) > 0, _let(_parts(values, part), sums)).otherwise(F.array().cast("array<int>"))


def _parts(values: Column, part: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / part).cast("int")), lambda i: F.slice(values, i * part + 1, F.lit(part)))


def _below(ordered: Column, value: Column) -> Column:
    """How many of some ordered values are less than a value, by halving."""
    steps = F.transform(F.sequence(F.ceil(F.log2(F.size(ordered) + F.lit(1))).cast("int"), F.lit(0), F.lit(-1)), lambda k: F.pow(F.lit(2.0), k).cast("int"))
    return F.aggregate(steps, F.lit(0), lambda at, n: F.when(F.get(ordered, at + n - 1) < value, at + n).otherwise(at))


def _positions(matches: Column, gaps: Column, kind: str, keep: Callable[[Column], Column]) -> Column:
    """Spans of the matches: each starts where the gaps and matches before it end, in code points.

    ``keep`` says of a span whether it stays; ``at`` is the number of its match.
    """

    def placed(pairs: Column, before: Column) -> Column:
        def span(pair: Column, i: Column) -> Column:
            start = before[i] + pair["gap"]
            return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(pair["value"])).alias("end"), pair["value"].alias("value"), i.alias("at"))

        return F.filter(F.transform(pairs, span), lambda s: keep(s))

    pairs = F.zip_with(matches, F.slice(gaps, F.lit(1), F.size(matches)), lambda v, g: F.struct(v.alias("value"), F.length(g).alias("gap"), (F.length(g) + F.length(v)).alias("both")))
    return _let(pairs, lambda p: _let(_running(F.transform(p, lambda x: x["both"])), lambda b: placed(p, b)))


def _spans_of(text: Column, kind: str, pattern: str, near: int) -> Column:
    """Spans of a kind with the text about them."""

    def about(s: Column, gaps: Column) -> Column:
        gap = lambda i: F.coalesce(F.get(gaps, s["at"] + i), F.lit(""))
        whole = [F.concat_ws(" ", *(gap(i) for i in way)) for way in ((-2, -1, 0), (1, 2, 3))]
        left = _let(whole[0], lambda x: F.when(F.length(x) > near, F.regexp_replace(F.substring(x, -near, near), r"^\S++", "")).otherwise(x))
        right = _let(whole[1], lambda x: F.when(F.length(x) > near, F.regexp_replace(F.substring(x, 1, near), r"(?<!\S)\S++$", "")).otherwise(x))
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), left.alias("left"), right.alias("right"))

    def spans(matches: Column, gaps: Column) -> Column:
        found = _positions(matches, gaps, kind, lambda s: _passes(kind, s["value"]))
        return F.transform(found, lambda s: about(s, gaps))

    none = F.array().cast("array<string>")
    matches = F.when(_maybe(kind, text), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    return _let(matches, lambda m: _let(F.when(F.size(m) > 0, F.split(text, pattern, -1)).otherwise(none), lambda g: spans(m, g)))


def base_spans(docs: DataFrame, text: str = "text", near: int = 320) -> DataFrame:
    """``docs`` with one column of spans for each kind: ``spans_email`` and so on. Null texts have none.

    A span also has ``left`` and ``right``: up to ``near`` code points of text about it, whole words, across one or two
    other matches of its kind, whose values are left out.
    """
    return docs.withColumns({f"spans_{kind}": _spans_of(F.col(text), kind, pattern, near) for kind, pattern in (PATTERNS | ADDED).items()})


def _terms(text: Column, least: int) -> Column:
    """Lower-cased terms of a text in order; e-mail addresses are no terms."""
    plain = F.when(text.contains("@"), F.regexp_replace(text, PATTERNS["email"], " ")).otherwise(text)
    return F.filter(F.split(F.lower(plain), r"[^\p{L}]+", -1), lambda t: F.length(t) >= least)


def _entity(s: Column) -> Column:
    return F.when(s["kind"].isin("card", "phone"), _digits(s["value"])).otherwise(F.lower(s["value"]))


def _contexts(found: DataFrame, window: int, least: int) -> DataFrame:
    """``kind, entity, term, context`` of each term within ``window`` terms of an entity, once for each row.

    A row's context of an entity and a term is what stands about one of the entity's places in it. Two more kinds of
    rows come along, so that one pass counts all: kind ``any`` once for each row and term near any entity, and an
    empty term once for each row and entity.
    """
    spans = F.concat(*(F.col(f"spans_{k}") for k in ALL))

    def near(s: Column) -> Column:
        before = F.slice(F.reverse(_terms(s["left"], least)), 1, window)
        after = F.slice(_terms(s["right"], least), 1, window)
        return F.struct(s["kind"].alias("kind"), _entity(s).alias("entity"), F.xxhash64(before, after).alias("context"), F.array_distinct(F.concat(before, after)).alias("terms"))

    rows = found.select(F.transform(spans, near).alias("near"))
    item = lambda kind, entity, term, context: F.struct(kind.alias("kind"), entity.alias("entity"), term.alias("term"), context.cast("long").alias("context"))
    each = F.flatten(F.transform("near", lambda n: F.transform(n["terms"], lambda t: item(n["kind"], n["entity"], t, n["context"]))))
    zero = F.lit(0).cast("long")
    whole = F.transform("near", lambda n: item(n["kind"], n["entity"], F.lit(""), zero))
    every = F.transform(F.flatten(F.transform("near", lambda n: n["terms"])), lambda t: item(F.lit("any"), F.lit(""), t, zero))
    same = lambda a, b: (a["kind"] == b["kind"]) & (a["entity"] == b["entity"]) & (a["term"] == b["term"])
    once = _let(F.array_sort(F.concat(each, whole, every)), lambda all_: F.filter(all_, lambda x, i: (i == 0) | ~same(F.get(all_, i - 1), x)))
    return rows.select(F.explode(once).alias("n")).select("n.*")


def _semi(rows: DataFrame, terms: DataFrame, size: int) -> DataFrame:
    """Rows whose term is in ``terms`` (distinct): sent to all if few, else both sides shuffle."""
    return rows.join(F.broadcast(terms) if size <= BROADCAST_TERMS else terms, "term")


def revealing_terms(found: DataFrame, window: int = 8, least: int = 2, support: int = 3, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """``term, kind, disclosure, action`` of the terms that reveal an entity.

    ``found`` has ``text`` and the spans. A pair counts once it is seen in ``support`` different contexts of different
    rows, so that copies of one passage are no evidence. Terms below ``least`` letters are not judged. Disclosure is log(P(entity | term) / P(entity)) / log(1 / P(entity)).
    """
    there = F.exists(F.array(*(F.size(f"spans_{k}") > 0 for k in ALL)), lambda x: x)
    near = cut(_contexts(found.where(there), window, least).groupBy("kind", "entity", "term", "context").agg(F.count("*").alias("n")))
    total = found.count()
    by_entity = near.where("term = ''").select("kind", "entity", (F.col("n") / F.lit(float(max(total, 1)))).alias("prior")).where("prior < 1")
    near_any = near.where("kind = 'any'").select("term", F.col("n").alias("n_near"))
    pairs = near.where("kind <> 'any' AND term <> ''").groupBy("kind", "entity", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts")).where(F.col("contexts") >= support)
    # a term is in at least as many rows as it is near an entity in: pairs that cannot reach the threshold go early
    disclosure = lambda n: F.log(F.least(F.col("n_both") / F.col(n), F.lit(1.0)) / F.col("prior")) / -F.log("prior")
    pairs = cut(pairs.join(by_entity, ["kind", "entity"]).join(near_any, "term").where(disclosure("n_near") >= generalise).drop("n_near"))
    wanted = pairs.select("term").distinct()
    size = wanted.count()
    rows = found.select(F.explode(F.array_distinct(_terms(F.col("text"), least))).alias("term"))
    # all terms are counted before the join: a row for each term and task, not for each occurrence of a wanted one
    by_term = _semi(rows.groupBy("term").agg(F.count("*").alias("n_term")), wanted, size)
    scored = pairs.join(by_term, "term").withColumn("disclosure", disclosure("n_term")).where(F.col("disclosure") >= generalise)
    best = scored.groupBy("term").agg(F.max(F.struct("disclosure", "kind")).alias("x"))
    return best.select("term", "x.kind", "x.disclosure", F.when(F.col("x.disclosure") >= remove, "remove").otherwise("generalise").alias("action"))


def _sanitised(text: Column, spans: Column) -> Column:
    """The text with each span replaced; overlapping spans are one. Near linear in the text and in its spans."""
    size = lambda xs: F.size(xs) * PIECE

    def between(pieces: Column, start: Column, end: Column) -> Column:
        """Code points of the text from ``start`` to ``end``, from the pieces that they are in."""
        first, last = F.floor(start / PIECE).cast("int"), F.floor(end / PIECE).cast("int")
        piece = lambda i: F.coalesce(F.get(pieces, i), F.lit(""))
        tail = F.substring(piece(first), start % PIECE + 1, F.lit(PIECE))
        return F.when(first == last, F.substring(piece(first), start % PIECE + 1, end - start)).otherwise(
            F.concat(tail, F.array_join(F.slice(pieces, first + 2, last - first - 1), ""), F.substring(piece(last), F.lit(1), end % PIECE))
        )

    def replaced(pieces: Column, ordered: Column, done: Column) -> Column:
        """``done`` is for each span the end of those before it."""
        placed = F.zip_with(ordered, done, lambda s, at: F.struct(s.alias("s"), at.alias("at")))
        mark = lambda s: F.when(s["kind"] == "term", s["value"]).otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
        out = F.transform(F.filter(placed, lambda x: x["s"]["start"] >= x["at"]), lambda x: F.concat(between(pieces, x["at"], x["s"]["start"]), mark(x["s"])))
        end = F.greatest(F.element_at(done, -1), F.element_at(ordered, -1)["end"])
        return F.array_join(F.concat(out, F.array(between(pieces, end, size(pieces)))), "")

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"))))
    pieces = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
    ends = lambda xs: _running(F.transform(xs, lambda s: s["end"]), lambda a, b: F.greatest(a, b))
    whole = _let(pieces, lambda p: _let(ordered, lambda o: _let(ends(o), lambda e: replaced(p, o, e))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)


def sanitise(docs: DataFrame, text: str = "text", key: str = "doc_id", window: int = 8, least: int = 2, support: int = 3, generalise: float = 0.8, remove: float = 0.95) -> DataFrame:
    """``key, text, spans_<kind>..., spans_term, sanitised`` of every row.

    Spans are ``kind, start, end`` (code points, end exclusive) and ``value``; for terms the value is what replaces
    them. Base matches are leftmost and do not overlap within a kind; matches that fail their check are dropped. The
    kind ``secret`` is added to the base kinds. Terms inside another span are left to it. Null texts count as empty;
    rows may repeat and keys may be null: equal keys share the terms found for any of them, each in its own text.
    Other columns are left out.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = base_spans(rows, near=40 * window)
    terms = cut(revealing_terms(found, window, least, support, generalise, remove))
    size = terms.count()
    seen = found.select("key", F.explode(F.array_distinct(_terms(F.col("text"), least))).alias("term"))
    placeholder = F.when(F.col("action") == "remove", F.lit("")).otherwise(F.concat(F.lit("<"), "kind", F.lit(" term>")))
    hits = _semi(seen, terms, size).groupBy("key").agg(F.map_from_entries(F.collect_set(F.struct("term", placeholder.alias("by")))).alias("hits"))
    if size == 0:
        joined = found.withColumn("hits", F.lit(None).cast("map<string,string>"))
    else:
        joined = found.join(hits.withColumnRenamed("key", "hit_key").hint("shuffle_hash"), F.col("key").eqNullSafe(F.col("hit_key")), "left").drop("hit_key")
    plain = lambda c: F.transform(c, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value")))
    joined = joined.withColumns({f"spans_{k}": plain(F.col(f"spans_{k}")) for k in ALL}).withColumn("_base", F.concat(*(F.col(f"spans_{k}") for k in ALL)))

    def terms_of(starts: Column, reach: Column, keys: Column, values: Column) -> Column:
        """``starts`` of the spans in order, ``reach``: the furthest end of as many of them; terms in order with what replaces them."""
        term = lambda s: F.lower(s["value"])
        few = F.size(keys) <= MANY
        free = lambda s: F.get(reach, _below(starts, s["end"])) <= s["start"]
        hit = lambda s: F.when(few, F.array_contains(keys, term(s))).otherwise(F.coalesce(F.get(keys, _below(keys, term(s))) == term(s), F.lit(False)))
        keep = lambda s: F.when(hit(s), free(s)).otherwise(False)
        by = lambda s: F.when(few, F.col("hits")[term(s)]).otherwise(F.get(values, _below(keys, term(s))))
        found = _let(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), lambda m: _positions(m, F.split("text", TERM, -1), "term", keep))
        return F.transform(found, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), by(s).alias("value")))

    def with_spans(base: Column, terms: Column) -> Column:
        ends = F.transform(base, lambda s: s["end"])
        reach = F.concat(_running(ends, lambda a, b: F.greatest(a, b)), F.array(F.coalesce(F.array_max(ends), F.lit(0))))
        part = lambda xs, name: F.transform(xs, lambda x: x[name])
        return _let(part(base, "start"), lambda b: _let(reach, lambda r: _let(part(terms, "key"), lambda k: _let(part(terms, "value"), lambda v: terms_of(b, r, k, v)))))

    by_start = F.array_sort(F.transform("_base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    found_terms = _let(by_start, lambda b: _let(F.array_sort(F.map_entries("hits")), lambda t: with_spans(b, t)))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    out = joined.withColumn("spans_term", F.when(F.col("hits").isNotNull(), found_terms).otherwise(none))
    out = out.withColumn("sanitised", _sanitised(F.col("text"), F.concat("_base", F.col("spans_term"))))
    return out.select(F.col("key").alias(key), "text", *(f"spans_{k}" for k in (*ALL, "term")), "sanitised")


def joined(*spans: str) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return reduce(lambda a, b: F.concat(a, b), [F.transform(F.col(c), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])) for c in spans])
