"""Reduplication, affixes and roots as row-local expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.functions import constants as K
from lexispark.functions.config import Affixes
from lexispark.functions.text import rx


def reduplication_base(word: Column, patterns: tuple[str, ...] = tuple(K.REDUPLICATIONS)) -> Column:
    """Base of a reduplicated word, of the first pattern that fits; else null."""
    return F.coalesce(*[F.nullif(F.regexp_extract(word, rx(p, "i"), 1), F.lit("")) for p in patterns])


def affix_hits(word: Column, affixes: Affixes | None = None) -> Column:
    """Array of (kind, root) in the order of the rules, roots of two characters or more."""
    hits = []
    for kind, _, pattern in (affixes or Affixes.default()).rules:
        root = F.regexp_extract(word, rx(pattern), 1)
        hits.append(F.when(F.length(root) >= K.MIN_ROOT, F.struct(F.lit(kind).alias("kind"), root.alias("root"))))
    return F.array_compact(F.array(*hits))


def root_of(word: Column, affixes: Affixes | None = None) -> Column:
    """Reduplication base, else the root of the first affix that fits, else null."""
    return F.coalesce(reduplication_base(word), F.get(affix_hits(word, affixes), F.lit(0))["root"])


def analyze_morphology(entries: DataFrame, affixes: Affixes | None = None) -> DataFrame:
    """One finding for each entry whose headword isn't its own root."""
    word = F.col("headword")
    rows = entries.withColumn("_base", reduplication_base(word)).withColumn("_hits", affix_hits(word, affixes))
    rows = rows.withColumn("root", F.coalesce("_base", F.get("_hits", F.lit(0))["root"])).where(F.col("root") != word)
    has = lambda kind: F.exists("_hits", lambda h: h["kind"] == kind)
    action = (
        F.when(F.col("_base").isNotNull(), "keep_as_entry")
        .when(has("prefix"), "flag_as_variant")
        .when(has("suffix"), "cross_reference")
        .otherwise("keep_as_entry")
    )
    kind = F.when(F.col("_base").isNotNull(), "reduplication").otherwise(F.get("_hits", F.lit(0))["kind"])
    return rows.select(kind.alias("type"), F.col("headword").alias("derived_form"), "root", F.col("id").alias("entry_id"), action.alias("action"))


def derived_forms(entries: DataFrame, affixes: Affixes | None = None) -> DataFrame:
    """Distinct words of each root, sorted."""
    rows = entries.select("headword").distinct().withColumn("root", root_of(F.col("headword"), affixes)).where("root is not null")
    return rows.groupBy("root").agg(F.array_sort(F.collect_list("headword")).alias("derived_forms"))


def conventions_section(entries: DataFrame, affixes: Affixes | None = None) -> DataFrame:
    """Lines of a Markdown section: a root and its first five derived forms."""
    rows = derived_forms(entries, affixes)
    line = F.concat(F.lit("- `"), "root", F.lit("`: "), F.array_join(F.slice("derived_forms", 1, 5), ", "))
    return rows.select("root", line.alias("line"))
