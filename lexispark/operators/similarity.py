"""Ratcliff-Obershelp similarity joins of short strings.

The ratio of strings of lengths a and b with m matching characters is 2 m / (a + b).  m is at most the shorter length and
at most the common part of the two character bags, so both bounds are lossless filters.  Pairs come from equi-joins, not a cross
join.  Words of usual length meet in common subsequences that are long enough, of which a word has few.  For longer words,
of which these would be too many, characters are numbered by occurrence and sorted from rare to frequent in the corpus; a
pair that reaches the ratio shares one among the first few (prefix filter of Chaudhuri, Ganti and Kaushik, ICDE 2006).
"""

from __future__ import annotations

import math
from difflib import SequenceMatcher
from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

#: Words up to this length leave at most 576 rests at a ratio of 0.85.
LONG = 15


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Order matters: the first string is the first argument of the matcher."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def _bag(word: Column) -> Column:
    """Characters with their occurrence, a#1, b#1, a#2, as 64-bit hashes."""
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    return F.transform(chars, lambda c, i: F.xxhash64(c, F.size(F.filter(F.slice(chars, 1, i + 1), lambda d: d == c))))


def _reach(n: Column, need: float) -> Column:
    """Of a word of length n, how many characters may go before the rest is too short for any partner."""
    return n - F.ceil(n * need - 1e-9)


@F.pandas_udf(ArrayType(StringType()))
def _rests(words: pd.Series, spare: pd.Series) -> pd.Series:
    """The distinct strings that are left of each word without up to spare characters."""
    return pd.Series([list({"".join(c) for k in range(n + 1) for c in combinations(w, len(w) - k)}) for w, n in zip(words, spare, strict=True)], dtype="object")


def similar_pairs(words: DataFrame, threshold: float) -> DataFrame:
    """words(word, first) -> (left, right, ratio) with ratio >= threshold; left is the one with the smaller first.

    first orders the words (their first place); words are read more than once, so they are best a table.
    """
    need = threshold / (2 - threshold)
    sized = words.select("word", "first", F.length("word").alias("n")).where("n > 0")
    found = _by_rests(sized, threshold, need).unionByName(_by_rare_characters(sized, threshold, need)).distinct()
    return found.withColumn("ratio", ratio("left", "right")).where(F.col("ratio") >= threshold)


def _by_rests(sized: DataFrame, threshold: float, need: float) -> DataFrame:
    """Candidates of words up to LONG characters: the matching characters are a common subsequence, which both words leave
    when the others go.  Words meet in what is left of them, by its hash, and only where it is long enough for the ratio."""
    parts = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short = sized.where(F.col("n") <= LONG).repartition(parts).withColumn("rest", F.explode(_rests("word", _reach(F.col("n"), need).cast("int"))))
    short = short.select(F.xxhash64("rest").alias("h"), F.length("rest").alias("m"), F.struct("first", "word", "n").alias("a"))
    met = short.groupBy("h", "m").agg(F.collect_list("a").alias("all")).where(F.size("all") > 1).select("m", "all", F.explode("all").alias("a"))
    fits = lambda b: (F.col("a.first") < b["first"]) & (2 * F.col("m") >= threshold * (F.col("a.n") + b["n"]) - 1e-9)
    return met.select(F.col("a.word").alias("left"), F.explode(F.filter("all", fits)).alias("b")).select("left", F.col("b.word").alias("right"))


def _by_rare_characters(sized: DataFrame, threshold: float, need: float) -> DataFrame:
    """Candidates with a word of more than LONG characters.  With a pair's lengths within the band, at least t (a + b) / 2
    >= n t / (2 - t) characters of a word of length n must match, so n - ceil(n t / (2 - t)) + 1 rarest characters hold a
    common one."""
    bags = sized.where(F.col("n") >= math.ceil((LONG + 1) * need - 1e-9)).withColumn("bag", _bag(F.col("word")))
    grams = bags.select("word", F.explode("bag").alias("g"))
    frequency = grams.groupBy("g").count()
    ranked = grams.join(frequency, "g").withColumn("_k", F.row_number().over(Window.partitionBy("word").orderBy("count", "g")))
    prefix = ranked.join(bags, "word").where(F.col("_k") <= _reach(F.col("n"), need) + 1)
    # Lengths are part of the key: the other word's length is one of few.
    own = prefix.select("g", "word", "first", "n", "bag")
    low, high = F.ceil(F.col("n") * need - 1e-9), F.floor(F.col("n") / need + 1e-9)
    other = own.select("g", F.col("word").alias("w2"), F.col("first").alias("f2"), F.col("n").alias("n2"), F.col("bag").alias("b2"))
    reach = own.withColumn("n2", F.explode(F.sequence(low.cast("int"), high.cast("int"))))
    pairs = reach.where(F.greatest("n", "n2") > LONG).join(other, ["g", "n2"]).where(F.col("first") < F.col("f2"))
    bound = 2 * F.size(F.array_intersect("bag", "b2")) >= threshold * (F.col("n") + F.col("n2")) - 1e-9
    return pairs.where(bound).select(F.col("word").alias("left"), F.col("w2").alias("right"))
