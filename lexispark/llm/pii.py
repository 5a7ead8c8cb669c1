"""Personal data by bootstrapped contextual extraction, with DataFrame operations only.

Seeds are the base matches: e-mail addresses, IP addresses, card numbers (13 to 19 digits, Luhn) and phone numbers (9 to
15 digits).  Candidates are words with an @ inside or six digits or more that overlap no seed.  The two words before a
mention and the two words after it (lower-cased, digits as 0) are its lexical patterns.  Patterns and values form a
graph: a pattern's confidence for a kind is the share of its distinct values that are of that kind, weighted by their
scores and discounted for few values; a candidate's score is the chance that one of its patterns is right,
1 - product of (1 - confidence).  Scores and confidences take turns for ROUNDS rounds.  Candidates that reach ACCEPTED and
have the rough shape of the kind become spans of it.

Base spans always stay.  Positions are code points, ends exclusive.

Defined results: null and empty texts have no spans; kinds are searched apart and may overlap; equal scores take the kind
that is listed first; rows that repeat get equal results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.common import WORD, Scratch

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
CONFIDENT = 0.5
ACCEPTED = 0.8
#: Code points on either side that are searched for the words of a pattern.
AROUND = 80

_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: The base patterns, written so that Java neither recurses nor tries a run of characters again from its middle.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without a match of its kind's guard has no span of it.
GUARDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
SHAPES = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^[0-9]+(?:[.:][0-9]+){3,}$",
    "card": r"^[0-9](?:[\x20-]?[0-9]){11,22}$",
    "phone": r"^[+(]?[0-9][().0-9/-]{5,}$",
}
_SPAN = "struct<kind:int,start:int,end:int>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body has lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def luhn(digits: Column) -> Column:
    """Is the check sum of a string of digits right?"""
    places = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, i: let(d.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x)),
    )
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(f"^{_BYTE}(?:\\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits).between(13, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _located(text: Column, pattern: str, keep: Callable[[Column], Column], make: Callable[[Column, Column, Column], Column]) -> Column:
    """make(match, start, end) for the matches that keep allows; splitting by the pattern gives what lies between."""

    def body(x: Column) -> Column:
        kept = F.filter(F.transform(x["m"], lambda m, i: F.struct(m.alias("m"), i.alias("i"))), lambda s: keep(s["m"]))

        def place(s: Column) -> Column:
            gaps = F.aggregate(F.slice(x["g"], 1, s["i"] + 1), F.lit(0), lambda a, n: a + n)
            matches = F.aggregate(F.slice(x["n"], 1, s["i"]), F.lit(0), lambda a, n: a + n)
            return let(gaps + matches, lambda at: make(s["m"], at, at + F.length(s["m"])))

        return F.transform(kept, place)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = let(
        matches,
        lambda m: F.struct(
            m.alias("m"), F.transform(m, F.length).alias("n"), F.transform(F.split(text, pattern, -1), F.length).alias("g")
        ),
    )
    return let(parts, body)


def base_spans(text: Column) -> Column:
    """Array of (kind, start, end) by kind, then start."""
    none = F.array().cast(f"array<{_SPAN}>")
    found = []
    for k, kind in enumerate(KINDS):
        spans = _located(
            text,
            PATTERNS[kind],
            lambda m, kind=kind: _valid(kind, m),
            lambda _, s, e, k=k: F.struct(F.lit(k).alias("kind"), s.alias("start"), e.alias("end")),
        )
        found.append(F.when(text.rlike(GUARDS[kind]), spans).otherwise(none))
    return F.concat(*found)


def _candidates(text: Column, base: Column) -> Column:
    """Words that may be identifiers and overlap no base span: array of (start, end, value)."""

    def keep(word: Column) -> Column:
        return word.rlike("(?:[0-9][^0-9]*+){6}|[^@]@[^@]")

    def make(word: Column, start: Column, end: Column) -> Column:
        front = F.length(word) - F.length(F.regexp_replace(word, r"^[^\p{L}\p{N}+(]++", ""))
        value = F.regexp_replace(F.regexp_replace(word, r"^[^\p{L}\p{N}+(]++", ""), r"[^\p{L}\p{N}]+$", "")
        return F.struct((start + front).alias("start"), (start + front + F.length(value)).alias("end"), value.alias("value"))

    words = _located(text, WORD, keep, make)
    apart = F.filter(
        words,
        lambda w: (F.length(w["value"]) > 0) & ~F.exists(base, lambda b: (b["start"] < w["end"]) & (b["end"] > w["start"])),
    )
    return F.when(text.rlike("(?:[0-9][^0-9\\x20\\x09-\\x0D]*+){6}|@"), apart).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>")
    )


def _patterns(text: Column, start: Column, end: Column) -> Column:
    plain = lambda c: F.regexp_replace(F.lower(c), "[0-9]", "0")
    low = F.greatest(start - AROUND, F.lit(0))
    before = F.regexp_extract(text.substr(low + 1, start - low), r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)[^\p{L}\p{N}]*$", 1)
    after = F.regexp_extract(text.substr(end + 1, F.lit(AROUND)), r"^[^\p{L}\p{N}]*([^\x20\x09-\x0D]+[\x20\x09-\x0D]+[^\x20\x09-\x0D]+)", 1)
    return F.filter(F.array(F.concat(F.lit("<"), plain(before)), F.concat(F.lit(">"), plain(after))), lambda p: F.length(p) > 1)


def _mentions(text: Column, base: Column, candidates: Column) -> Column:
    """(kind or null, start, end, value, patterns) of base spans and candidates."""
    seeds = F.transform(
        base,
        lambda b: F.struct(
            b["kind"].alias("kind"),
            b["start"].alias("start"),
            b["end"].alias("end"),
            F.lower(text.substr(b["start"] + 1, b["end"] - b["start"])).alias("value"),
            _patterns(text, b["start"], b["end"]).alias("patterns"),
        ),
    )
    others = F.transform(
        candidates,
        lambda c: F.struct(
            F.lit(None).cast("int").alias("kind"),
            c["start"].alias("start"),
            c["end"].alias("end"),
            F.lower(c["value"]).alias("value"),
            _patterns(text, c["start"], c["end"]).alias("patterns"),
        ),
    )
    return F.concat(seeds, others)


def bootstrap(mentions: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """mentions(kind, value, patterns) -> (value, kind, score) of the candidates that patterns speak for."""
    edges = mentions.select("kind", "value", F.explode("patterns").alias("pattern")).groupBy("pattern", "value", "kind").count()
    edges = scratch.table(edges.select("pattern", "value", "kind"))
    seeds = scratch.table(edges.where("kind is not null").select("value", "kind").distinct().withColumn("score", F.lit(1.0)))
    open_edges = scratch.table(
        edges.where("kind is null").select("pattern", "value").join(seeds.select("value").distinct(), "value", "left_anti")
    )
    size = scratch.table(edges.groupBy("pattern").agg(F.count_distinct("value").alias("n")))
    scores = seeds.where("false")
    for _ in range(rounds):
        known = seeds.unionByName(scores)
        support = edges.select("pattern", "value").distinct().join(known, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("support"))
        confident = support.join(size, "pattern").withColumn("confidence", F.col("support") / F.col("n") * (1 - 1 / (1 + F.col("support"))))
        confident = scratch.table(confident.where(F.col("confidence") >= CONFIDENT).select("pattern", "kind", "confidence"))
        scores = scratch.table(
            open_edges.join(confident, "pattern")
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.999)))))).alias("score"))
        )
    return scores


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"]))
    return F.array_join(text, ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs -> doc_id, base and spans (arrays of (kind, start, end) by kind, then start)."""
    scratch = Scratch(docs.sparkSession, "pii")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    # An explode keeps what was computed before it from being computed again for each use.
    rows = rows.withColumn("base", F.explode(F.array(base_spans(F.col("text")))))
    rows = rows.withColumn("candidates", F.explode(F.array(_candidates(F.col("text"), F.col("base")))))
    found = scratch.table(
        rows.select(
            "doc_id",
            F.xxhash64("text").alias("text_key"),
            "base",
            F.when((F.size("base") > 0) | (F.size("candidates") > 0), _mentions(F.col("text"), F.col("base"), F.col("candidates"))).alias("mentions"),
        )
    )
    mentions = scratch.table(
        found.where("mentions is not null").select("doc_id", "text_key", F.explode("mentions").alias("m")).select("doc_id", "text_key", "m.*")
    )
    scores = bootstrap(mentions, scratch)
    shape = F.lit(False)
    for k, kind in enumerate(KINDS):
        shape = shape | ((F.col("kind") == k) & F.col("value").rlike(SHAPES[kind]))
    good = scores.where(shape & (F.col("score") >= ACCEPTED)).groupBy("value").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("_b"))
    good = scratch.table(good.select(F.col("value").alias("_v"), (-F.col("_b.k")).alias("_kind")))
    added = mentions.where("kind is null").join(good, F.col("value") == F.col("_v"))
    added = added.groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(
        F.array_distinct(F.collect_list(F.struct(F.col("_kind").alias("kind"), "start", "end"))).alias("_more")
    )
    added = scratch.table(added)
    both = found.join(added, found["doc_id"].eqNullSafe(added["_id"]) & (found["text_key"] == added["_key"]), "left")
    none = F.array().cast(f"array<{_SPAN}>")
    spans = F.when(F.col("_more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", F.coalesce("_more", none))))
    return both.select("doc_id", "base", spans.alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The columns of the query's contract."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
