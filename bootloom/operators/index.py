"""Dense row positions without a global sort.

Rows are grouped into buckets, aligned intervals of 2**s neighbouring ids named by the first of
them. The buckets are counted, and a running sum in two levels, of ranges of buckets and within a
range, gives each bucket the position of its first row. Row ids are unique, so a bucket of
2**s ids holds at most 2**s rows; only where ids are sparse and clustered can a bucket be
much fuller than its neighbours, and such buckets are split again until none is. The
wanted size of a bucket does not depend on the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scratch import staged
from ..sources.frames import ROW_ID, FrameStats

BUCKET = "_bucket"
# A bucket is split when it holds more than this many times the wanted rows.
FULLNESS = 4
# The running sum is first taken over about this many ranges of ids.
RANGE_BITS = 12
# Intervals of more ids than this would not be aligned in 64 bits.
MAX_SHIFT = 61


def _shift_for(n: int, lo: int, hi: int, wanted: int) -> int:
    """Largest shift at which an even spread of ids puts at most `wanted` rows in a bucket."""
    ids_per_bucket = (hi - lo + 1) * wanted // max(n, 1)
    return min(max(ids_per_bucket.bit_length() - 1, 0), MAX_SHIFT)


def _first_id(row_id: str, size: Column) -> Column:
    """The first id of the aligned interval of `size` ids (a power of two) that holds the row's."""
    return F.col(row_id).bitwiseAND(-size)


def bucket_rows(df: DataFrame, stats: FrameStats, wanted: int,
                row_id: str = ROW_ID) -> DataFrame:
    """Add a BUCKET column; ids within a bucket are neighbours, buckets are balanced."""
    wanted = max(wanted, 1)
    size = 1 << _shift_for(stats.n, stats.min_id, stats.max_id, wanted)
    df = df.withColumn(BUCKET, _first_id(row_id, F.lit(size).cast("long")))
    while size > FULLNESS * wanted:
        n, ids = F.col("n"), F.col("hi") - F.col("lo") + 1
        # at least 4 times smaller than the interval that is split
        smaller = F.greatest(F.lit(0), F.floor(F.log2(ids * F.lit(float(wanted)) / n))).cast("int")
        full = staged(df.groupBy(BUCKET).agg(
            F.count("*").alias("n"), F.min(row_id).alias("lo"), F.max(row_id).alias("hi"))
            .where(n > FULLNESS * wanted).select(
                BUCKET, smaller.alias("_shift"), (n > ids).alias("_repeated")), "full")
        found = full.agg(F.count("*").alias("n"), F.max("_shift").alias("shift"),
                         F.bool_or("_repeated").alias("repeated")).first()
        if not found["n"]:
            break
        if found["repeated"]:
            raise ValueError(f"{row_id} is not unique")
        size = 1 << found["shift"]
        split = full.select(BUCKET, F.expr("shiftleft(1L, _shift)").alias("_size"))
        df = (df.join(split, BUCKET, "left")
              .withColumn(BUCKET, F.coalesce(_first_id(row_id, F.col("_size")), BUCKET))
              .drop("_size"))
    return df


def bucket_table(bucketed: DataFrame, stats: FrameStats, row_id: str = ROW_ID) -> DataFrame:
    """One row per bucket: its size and the position of its first row. The sizes are written, as
    they are read once for the ranges' sums and once for those within a range; only the
    some 2**RANGE_BITS sums of ranges pass through one task."""
    n, lo, hi = F.count("*"), F.min(row_id), F.max(row_id)
    shift = max((stats.max_id - stats.min_id).bit_length() - RANGE_BITS, 0)
    sizes = staged(bucketed.groupBy(BUCKET).agg(
        F.when(n <= hi - lo + 1, n).otherwise(F.raise_error(F.lit(f"{row_id} is not unique")))
        .alias("_bucket_rows")).withColumn("_range", F.shiftright(BUCKET, shift)), "buckets")
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("_range").agg(F.sum("_bucket_rows").alias("_rows")).select(
        "_range", F.sum("_rows").over(earlier.orderBy("_range")).alias("_before"))
    within = F.sum("_bucket_rows").over(earlier.partitionBy("_range").orderBy(BUCKET))
    return (sizes.withColumn("_within", within).join(F.broadcast(ranges), "_range")  # bounded above
            .select(BUCKET, "_bucket_rows", (F.coalesce("_before", F.lit(0))
                                             + F.coalesce("_within", F.lit(0))).alias("_offset")))


def dense_index(df: DataFrame, stats: FrameStats, row_id: str = ROW_ID,
                wanted: int = 1 << 14) -> DataFrame:
    """Add `position`: the rank 0..n-1 of each row in the order of its id."""
    bucketed = bucket_rows(df, stats, wanted, row_id)
    within = F.row_number().over(Window.partitionBy(BUCKET).orderBy(row_id)) - 1
    return (bucketed.join(bucket_table(bucketed, stats, row_id), BUCKET)
            .withColumn("position", F.col("_offset") + within)
            .drop(BUCKET, "_bucket_rows", "_offset"))
