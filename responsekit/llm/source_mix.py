"""Mixing sources to target weights (operator 6) by Efraimidis-Spirakis sampling.

Each source has a token budget: its weight's share of a multiple of all words,
never above ``MAX_EPOCHS`` times its own size; what is above is shared out again
by weight. A budget of at least the source's size takes every document once
(complete epochs); what is left of it is filled in the order of exponential keys
``-ln(u) / quality`` (u: a hash of id and text), a weighted sample without
replacement, until the prefix sum of sizes reaches the budget. The document at
the boundary gives only its first words, so a source takes its budget to the word.

Scale: the prefix sum needs no sort of a whole source. Keys are cut into
``BUCKETS`` ranges per source; sums of sizes by (source, range) give each range's
prefix, and only rows of the one range that the budget ends in are sorted.

Only DataFrame functions are used. Defined cases: a null text has size 0; a
document of size 0 is taken 0 words; a null source is a source of its own, last
in order; an all-empty table has targets of 0; no documents give no rows;
repeated rows each count, and get the same key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from responsekit.llm.common import WORD, pack_row, read
from responsekit.session import materialize

#: Weights of the sources by code point, repeating; all budgets as a share of all words.
WEIGHTS = [5, 2, 1]
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
BUCKETS = 4096
SEED = 17
SYMBOLS = "#*$%&|<>"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for a text without symbols, less the more symbols per character it has (above 0 in any case)."""
    chars = F.greatest(F.length(text), F.lit(1))
    return F.coalesce(1 / (1 + 20 * (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))) / chars), F.lit(1.0))


def source_targets(sizes: DataFrame) -> DataFrame:
    """Budgets of ``sizes`` (source, source_size): water filling in closed form.

    A source's budget is min(MAX_EPOCHS * size, level * weight); sorted by the
    level at which they fill up, the sources before the common level are full.
    One row per source: this table is small next to the documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1)
    t = (sizes.withColumn("weight", weight.cast("double"))
         .withColumn("cap", (F.col("source_size") * MAX_EPOCHS).cast("double"))
         .withColumn("fills_at", F.col("cap") / F.col("weight")))
    every = Window.partitionBy()
    filling = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    t = (t.withColumn("total", F.sum("source_size").over(every) * TOTAL_SHARE)
         .withColumn("full_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("open_weight", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("rank", F.row_number().over(filling))
         .withColumn("level_here", (F.col("total") - F.col("full_before")) / F.col("open_weight")))
    # the common level is that of the first source in this order that isn't full at it
    level = F.min(F.when(F.col("level_here") < F.col("fills_at"),
                         F.struct("rank", "level_here"))).over(every)["level_here"]
    return t.select("source", "source_size",
                    F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight: Column | None = None, carry: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` (its columns, or those of ``carry``), with size, source,
    source_size, target and taken. ``weight`` is a positive quality near 1; null counts as 1."""
    text = F.col(text_col)
    quality = quality_weight(text) if weight is None else F.greatest(F.coalesce(weight, F.lit(1.0)), F.lit(1e-6))
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), text), 11) + 1) / F.lit(float(2 ** 53 + 1))
    keyed = docs.select(pack_row(docs, carry), F.col(source_col).alias("source"), n_words(text).alias("size"),
                        (-F.ln(u) / quality).alias("key"), F.xxhash64(F.col(id_col), text).alias("tie"))
    keyed = keyed.withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * BUCKETS).cast("int"))
    if carry is not None and text_col not in carry:
        keyed = materialize(keyed)  # narrow: the texts are then counted once
    sums = materialize(keyed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")))
    targets = source_targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    return _take(keyed, sums, targets)


def _take(keyed: DataFrame, sums: DataFrame, targets: DataFrame) -> DataFrame:
    targets = targets.select(F.col("source").alias("t"), "source_size", "target")
    prefix = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    plan = sums.join(targets, F.col("source").eqNullSafe(F.col("t")))
    plan = (plan.withColumn("budget", F.floor("target"))
            .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size"))).otherwise(0))
            .withColumn("part", F.col("budget") - F.col("epochs") * F.col("source_size"))
            .withColumn("left", F.col("part") - F.coalesce(F.sum("bucket_size").over(prefix), F.lit(0)))
            .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "source_size", "target", "epochs", "left",
                    (F.col("left") >= F.col("bucket_size")).alias("whole")))
    rows = keyed.join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    cols = ["row", "size", "source", "source_size", "target"]
    settled = rows.where("whole or left <= 0").select(
        *cols, (F.col("epochs") * F.col("size") + F.when(F.col("whole"), F.col("size")).otherwise(0)).alias("taken"))
    in_order = (Window.partitionBy("s", "b").orderBy("key", "tie")
                .rowsBetween(Window.unboundedPreceding, -1))
    ending = rows.where("not whole and left > 0")
    before = F.coalesce(F.sum("size").over(in_order), F.lit(0))
    ending = ending.withColumn("gives", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - before)))
    return settled.unionByName(ending.select(*cols, (F.col("epochs") * F.col("size") + F.col("gives")).alias("taken")))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, carry=["doc_id"]).select("row.doc_id", "size", "source_size", "target", "taken")
