"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Sources in code-point order, null last, have weights 1, 2, 3, repeating.  They share the total size by weight; a target
stops at three times its source's size, and what is over goes to the others by weight until none is above (the level t
with sum of min(cap, t weight) = total, found by running sums over the sources in order of cap / weight).

Entropy balancing looks for document rates w between 0 and MOST_COPIES that meet every source's token constraint, sum of
w size = target, and stay nearest to the base rate 1 in relative entropy, sum of w log w - w + 1 over the documents.  The
solution tilts documents exponentially in their tokens: w = min(MOST_COPIES, exp(lambda x)) with one multiplier a source
and x the size over the source's mean size.  The multipliers minimise the convex dual, whose gradient is the words taken
less the target and whose Hessian (diagonal, as each document has one source) is the sum of x size w over the documents
below the cap.  Newton steps use both, summed over the corpus; a step that leaves the bracket known so far is replaced by
the bracket's middle, or by doubling while a side of it is open.  So where a source shrinks, its long documents are taken
less often than its short ones, and where it grows, more often.

Rates are rounded into whole copies for each source and size: running sums of the expected copies from long to short
documents are rounded, so each source's documents of all lengths get their share; then the error in words that is left is
paid off by single copies, those of nearest size first, until none makes it smaller.  Within a size, a hash of the id
decides who gets the odd copy.

Defined results: null and empty texts have size 0 and take 0 words; a source without words has target 0; a table without
words has targets 0, an empty one gives no rows; very long texts are counted whole; rows that repeat, and rows with a null
id, count and are drawn one by one; ties in the hash go by id.  Extra columns are ignored by `entropy_mix` and kept by
`mixed`, whatever their names.  A task holds one row for each source, when sources are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexispark.llm.common import WORD, Scratch

MOST_COPIES = 3
#: Newton steps at most, and the error in words, as a share of the target, that ends them.
STEPS = 60
TOLERANCE = 1e-9
#: Documents of one source and size that are ranked together.
TOGETHER = 1000


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    count = F.coalesce(F.regexp_count(F.col(f"`{text_col}`").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), count.alias("size"), _key(id_col, source_col, text_col).alias("key")
    )


def _key(id_col: str, source_col: str, text_col: str) -> Column:
    """A 64-bit name of a row's id, source and text."""
    doc_id, source, text = F.col(f"`{id_col}`"), F.col(f"`{source_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")
    return F.xxhash64(doc_id, source, text, doc_id.isNull(), source.isNull())


def targets(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """classes(source, size, n) -> source, source_size, target."""
    total = classes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    # One row a source; these windows order the sources, not the documents.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    own = total.withColumn("weight", ((place - 1) % 3 + 1).cast("double"))
    own = own.withColumn("_cap", F.col("source_size") * float(MOST_COPIES))
    order = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    own = own.withColumn("_level", level).withColumn("_place", F.row_number().over(order))
    own = own.withColumn("_free", F.col("_cap") > F.col("_level") * F.col("weight"))
    first = F.min(F.when(F.col("_free"), F.struct("_place", "_level"))).over(every)
    target = F.when(F.col("_free"), F.least("_cap", first["_level"] * F.col("weight"))).otherwise(F.col("_cap"))
    return scratch.table(own.select("source", "source_size", target.cast("double").alias("target")))


def multipliers(classes: DataFrame, wanted: DataFrame, scratch: Scratch) -> DataFrame:
    """Newton on the dual -> source, source_size, target, mean, lambda (infinite where the cap is the target)."""
    mean = classes.where("size > 0").groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean")).withColumnRenamed("source", "_s")
    start = wanted.join(mean, wanted["source"].eqNullSafe(mean["_s"]), "left").drop("_s")
    infinite = F.lit(float("inf"))
    full = F.col("target") >= MOST_COPIES * F.col("source_size") * (1 - TOLERANCE)
    first = F.when(F.col("target") <= 0, -infinite).when(full, infinite).otherwise(F.lit(0.0))
    state = start.withColumn("lambda", first).withColumn("_low", -infinite).withColumn("_high", infinite).withColumn("_open", F.abs(first) != infinite)
    state = scratch.table(state)
    for _ in range(STEPS):
        now = state.where("_open").select(F.col("source").alias("_s"), "mean", "lambda")
        x, tokens = F.col("size") / F.col("mean"), F.col("size") * F.col("n")
        tilt = F.exp(F.least(F.col("lambda") * x, F.lit(700.0)))
        sums = classes.join(now, classes["source"].eqNullSafe(now["_s"])).groupBy("_s").agg(
            F.sum(tokens * F.least(tilt, F.lit(float(MOST_COPIES)))).alias("_taken"),
            F.sum(F.when(tilt < MOST_COPIES, tokens * x * tilt).otherwise(0.0)).alias("_hessian"),
        )
        gradient = F.col("_taken") - F.col("target")
        done = F.abs(gradient) <= TOLERANCE * F.col("target")
        low = F.when(gradient < 0, F.col("lambda")).otherwise(F.col("_low"))
        high = F.when(gradient > 0, F.col("lambda")).otherwise(F.col("_high"))
        step = F.when(F.col("_hessian") > 0, F.col("lambda") - gradient / F.col("_hessian"))
        # The middle of the bracket; beyond its known side while the other one is open.
        middle = (
            F.when(F.col("_new_low") == -infinite, F.col("_new_high") - 1 - F.abs("_new_high"))
            .when(F.col("_new_high") == infinite, F.col("_new_low") + 1 + F.abs("_new_low"))
            .otherwise((F.col("_new_low") + F.col("_new_high")) / 2)
        )
        inside = step.isNotNull() & (step > F.col("_new_low")) & (step < F.col("_new_high")) & (F.abs(step - F.col("lambda")) <= 1 + F.abs("lambda"))
        new = (
            state.join(sums, state["source"].eqNullSafe(sums["_s"]), "left")
            .drop("_s")
            .withColumn("_new_low", F.when(F.col("_taken").isNull(), F.col("_low")).otherwise(low))
            .withColumn("_new_high", F.when(F.col("_taken").isNull(), F.col("_high")).otherwise(high))
            .withColumn("_still", F.col("_open") & F.col("_taken").isNotNull() & ~done & (F.col("_new_high") - F.col("_new_low") > 1e-13))
            .withColumn("lambda", F.when(F.col("_still"), F.when(inside, step).otherwise(middle)).otherwise(F.col("lambda")))
            .select("source", "source_size", "target", "mean", "lambda", F.col("_new_low").alias("_low"), F.col("_new_high").alias("_high"), F.col("_still").alias("_open"))
        )
        state = scratch.table(new)
        if state.where("_open").isEmpty():
            break
    return state.select("source", "source_size", "target", "mean", "lambda")


def rate(size: Column) -> Column:
    """The tilted rate of a document; needs mean and lambda."""
    tilt = F.exp(F.least(F.col("lambda") * size / F.col("mean"), F.lit(700.0)))
    return F.when((size <= 0) | (F.col("target") <= 0), F.lit(0.0)).otherwise(F.least(tilt, F.lit(float(MOST_COPIES))))


def copies_by_size(classes: DataFrame, rates: DataFrame, scratch: Scratch) -> DataFrame:
    """classes and rates -> source, size, n, source_size, target, copies (of all n documents together)."""
    r = rates.withColumnRenamed("source", "_s")
    run = Window.partitionBy("source").orderBy(F.col("size").desc())
    sums = F.sum(F.col("rate") * F.col("n")).over(run)
    rounded = F.floor(F.round(sums, 6) + 0.5).cast("long")
    now = (
        classes.join(r, classes["source"].eqNullSafe(r["_s"]))
        .drop("_s")
        .withColumn("rate", rate(F.col("size")))
        .withColumn("_upto", rounded)
        .withColumn("copies", F.col("_upto") - F.coalesce(F.lag("_upto").over(run), F.lit(0)))
        .withColumn("copies", F.greatest(F.lit(0), F.least("copies", F.col("n") * MOST_COPIES)).cast("long"))
        .select("source", "size", "n", "source_size", "target", "copies")
    )
    now = scratch.table(now)
    while True:
        error = now.groupBy("source").agg((F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("error"))
        error = error.withColumnRenamed("source", "_s")
        with_error = now.join(error, now["source"].eqNullSafe(error["_s"])).drop("_s")
        room = F.when(F.col("error") > 0, F.col("n") * MOST_COPIES - F.col("copies")).otherwise(F.col("copies"))
        off = F.abs("error")
        able = with_error.withColumn("_room", room).where((F.col("_room") > 0) & (F.col("size") > 0) & (F.col("size") < 2 * off))
        move = F.greatest(F.lit(1), F.least("_room", F.floor(off / F.col("size")))).cast("long")
        left = F.abs(off - F.col("size") * F.col("_move"))
        best = able.withColumn("_move", move).groupBy("source").agg(
            F.min(F.struct(left.alias("left"), F.col("size"), (F.signum("error") * F.col("_move")).cast("long").alias("move"), off.alias("off"))).alias("_b")
        )
        best = scratch.table(best.where("_b.left < _b.off").select(F.col("source").alias("_s"), F.col("_b.size").alias("_size"), F.col("_b.move").alias("_move")))
        if best.isEmpty():
            break
        new = scratch.table(
            now.join(best, now["source"].eqNullSafe(best["_s"]) & (now["size"] == best["_size"]), "left")
            .withColumn("copies", F.col("copies") + F.coalesce("_move", F.lit(0)))
            .drop("_s", "_size", "_move")
        )
        scratch.drop(now, best)
        now = new
    return now


def entropy_mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", scratch: Scratch | None = None
) -> DataFrame:
    """docs -> doc_id, source, size, key (a hash of id, source and text), source_size, target, copies; a row for each row."""
    scratch = scratch or Scratch(docs.sparkSession, "mixing")
    sized = scratch.table(sizes(docs, id_col, source_col, text_col))
    classes = scratch.table(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    found = multipliers(classes, targets(classes, scratch), scratch)
    shares = copies_by_size(classes, found, scratch)
    shares = shares.select(F.col("source").alias("_s"), F.col("size").alias("_size"), "n", "source_size", "target", "copies").hint("merge")
    rows = sized.join(shares, sized["source"].eqNullSafe(F.col("_s")) & (sized["size"] == F.col("_size"))).drop("_s", "_size")
    rows = rows.withColumn("_hash", F.xxhash64(F.lit("odd copy"), "key"))
    rows = rows.withColumn("_part", F.pmod("_hash", F.floor(F.col("n") / TOGETHER) + 1))
    group = ["source", "size"]
    counts = rows.groupBy(*group, "_part").agg(F.count("*").alias("_count"))
    upto = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = counts.withColumn("_start", F.coalesce(F.sum("_count").over(upto), F.lit(0)))
    start = scratch.table(start.select(F.col("source").alias("_s"), F.col("size").alias("_size"), F.col("_part").alias("_p"), "_start")).hint("merge")
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*group, "_part").orderBy("_hash", "doc_id")))
    ranked = ranked.join(
        start, ranked["source"].eqNullSafe(F.col("_s")) & (ranked["size"] == F.col("_size")) & (ranked["_part"] == F.col("_p"))
    )
    odd = (F.col("_start") + F.col("_rank") <= F.col("copies") % F.col("n")).cast("long")
    each = F.floor(F.col("copies") / F.col("n")).cast("long") + odd
    return ranked.select("doc_id", "source", "size", "key", "source_size", "target", each.alias("copies"))


def mixed(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", scratch: Scratch | None = None
) -> DataFrame:
    """docs -> its rows, each as often as the mix takes it; rows with one id, source and text share what is taken of them."""
    plan = entropy_mix(docs, id_col, source_col, text_col, scratch)
    plan = plan.groupBy(F.col("key").alias("__mix_key")).agg(F.sum("copies").alias("__mix_copies"), F.count("*").alias("__mix_n")).where("__mix_copies > 0")
    keyed = docs.withColumn("__mix_of", _key(id_col, source_col, text_col))
    joined = keyed.join(plan.hint("merge"), F.col("__mix_of") == F.col("__mix_key"))
    rank = F.row_number().over(Window.partitionBy("__mix_of").orderBy(F.xxhash64(*[f"`{c}`" for c in docs.columns])))
    odd = (rank <= F.col("__mix_copies") % F.col("__mix_n")).cast("long")
    each = F.floor(F.col("__mix_copies") / F.col("__mix_n")).cast("int") + odd.cast("int")
    drawn = joined.withColumn("__mix_each", each).where("__mix_each > 0").withColumn("__mix_k", F.explode(F.sequence(F.lit(1), F.col("__mix_each"))))
    return drawn.select(*[f"`{c}`" for c in docs.columns])
