"""Mix sources to target weights with hash-threshold histograms.

Each source gets a target number of words. A document of a source with target ``t`` and size
``S`` is repeated ``floor(t / S)`` times, and once more if its hash lies below the source's
threshold, so the budgets of successive repeats are nested. The threshold comes from counts, never
from a sort: words are summed by source and hash bucket, the running sum over the few buckets of a
source finds the bucket in which the budget ends, and only that bucket is cut into finer
buckets, until it holds one hash value. Documents are then filtered by a comparison.

The hash is the first 60 bits of the MD5 of seed, id and text, so reruns and other layouts take
the same documents. The last hash value is taken whole if that brings the source nearer to its target.
If several rows share it (rows with equal id and text) they share the rest of the budget evenly, in
words.

Targets: sources by code point (null last) weigh ``weights`` in turn and share ``share`` times all
words; a target stops at ``most`` times its source's size and the excess goes to the
others by weight until none is above. Null or empty texts have size 0 and take nothing. A null source
is a source of its own. An empty table gives an empty result. Columns of ``docs`` other than doc_id,
text and source are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fixtrail.llm.words import n_words
from fixtrail.operators.rowindex import with_row_id
from fixtrail.operators.staging import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
SEED = "mix"
#: Bits of the hash, and bits by which a histogram is finer than the one before.
HASH_BITS = 60
STEP_BITS = 10


def document_hash(seed: str = SEED) -> Column:
    """60 bits that depend on id and text alone."""
    text = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size, target of every source; ``sizes`` has source and size."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = with_row_id(
        sources.withColumn("_null", F.col("source").isNull().cast("int")), ("_null", "source"), (), "_place"
    ).rows
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    known = stage(ordered.select("source", "source_size", weight.alias("_weight")), "sources")
    cap = F.col("source_size") * F.lit(float(most))
    total = known.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    budget, rate, capped = share * total, 0.0, -1
    while True:  # each pass caps one source more at least; three numbers reach the driver
        above = cap < F.col("_weight") * F.lit(rate) if capped >= 0 else F.lit(False)
        n, held, free = known.agg(
            F.count_if(above), F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)), F.sum(F.when(~above, F.col("_weight")))
        ).first()
        if n == capped or not free:
            break
        capped, rate = n, (budget - held) / free
    return known.select("source", "source_size", F.least(cap, F.col("_weight") * F.lit(rate)).alias("target"))


def _thresholds(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """source, whole (repeats of every document), below (hash bound), at (hash), rest, n_at, size_at.

    Documents with a hash under ``below`` are taken once more; those with hash ``at`` share ``rest``.
    """
    live = stage(
        plan.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("rest", F.floor(F.col("target")) - F.col("whole") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("long")),
        "budgets",
    )
    for level in range(HASH_BITS // STEP_BITS):
        shift = HASH_BITS - STEP_BITS * (level + 1)
        bucket = F.shiftright("hash", shift)
        inside = sizes.where(F.col("size") > 0).select(
            F.col("source").alias("_source"), "size", bucket.alias("bucket"), F.shiftright(bucket, STEP_BITS).alias("_prefix")
        )
        counts = (
            inside.groupBy("_source", "_prefix", "bucket")
            .agg(F.sum("size").alias("size"), F.count("*").alias("n"))
            .join(live, F.col("_source").eqNullSafe(F.col("source")) & (F.col("_prefix") == F.col("prefix")))
        )
        # at most 2^STEP_BITS buckets of a source are in one group
        upto = Window.partitionBy("source").orderBy("bucket")
        counts = counts.withColumn("before", F.sum("size").over(upto) - F.col("size"))
        boundary = counts.where((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("size") > F.col("rest")))
        live = stage(
            boundary.select(
                "source", "source_size", "target", "whole", (F.col("rest") - F.col("before")).alias("rest"),
                F.col("bucket").alias("prefix"), "n", F.col("size").alias("size_at"),
            ),
            f"boundary_{level}",
        ).select("source", "source_size", "target", "whole", "rest", "prefix", *(["n", "size_at"] if shift == 0 else []))
    return live


def _words(size: Column | None) -> Column:
    return n_words("text") if size is None else size


def _taken() -> Column:
    """Words taken of a row that has size, hash and the columns of its source's end."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    nearer = F.col("_size_at") - F.col("_rest") < F.col("_rest")
    at_end = F.when(F.col("_n") == 1, F.when(nearer, F.col("size")).otherwise(0)).otherwise(
        F.least(F.col("size"), F.floor(F.col("_rest") / F.col("_n")))
    )
    # without a boundary the whole repeats already meet the budget
    more = F.when(F.col("hash") < F.col("_prefix"), F.col("size")).when(F.col("hash") == F.col("_prefix"), at_end)
    return (whole * F.col("size") + F.coalesce(more, F.lit(0))).cast("long")


def mix_plan(docs: DataFrame, weights: Sequence[float], share: float, most: float, seed: str, size: Column | None) -> tuple[DataFrame, DataFrame]:
    """Sizes of all rows, and per source its size, target and threshold."""
    sizes = stage(docs.select("doc_id", "source", document_hash(seed).alias("hash"), _words(size).alias("size")), "document_sizes")
    plan = stage(targets(sizes, weights, share, most), "targets")
    bound = _thresholds(sizes, plan).select(
        F.col("source").alias("_s"), F.col("prefix").alias("_prefix"), F.col("rest").alias("_rest"), F.col("n").alias("_n"), F.col("size_at").alias("_size_at")
    )
    ends = plan.join(bound, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s").withColumnRenamed("source", "_of")
    return sizes, stage(ends, "mix_plan")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
    size: Column | None = None,
) -> DataFrame:
    """doc_id, source, hash, size, source_size, target, taken for every row of ``docs``."""
    sizes, ends = mix_plan(docs, weights, share, most, seed, size)
    return sizes.join(ends, F.col("source").eqNullSafe(F.col("_of"))).select(
        "doc_id", "source", "hash", "size", "source_size", "target", _taken().alias("taken")
    )


def mixed_rows(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = SEED,
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all columns; a cut repeat counts from a half on."""
    _, ends = mix_plan(docs, weights, share, most, seed, None)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(own, "source", document_hash(seed).alias("hash"), _words(None).alias("size"))
    taken = rows.where(F.col("size") > 0).join(ends, F.col("source").eqNullSafe(F.col("_of"))).withColumn(
        "_times", F.round(_taken() / F.col("size")).cast("int")
    )
    repeated = taken.where(F.col("_times") > 0).select("_row", F.explode(F.array_repeat(F.lit(1), F.col("_times"))))
    return repeated.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns])
