"""At most a share or number of records for each contributor, the best by score, by radix selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codequarry.operators import radix
from codequarry.session import BROADCAST_ROWS, Scratch, hot_keys, salted_join


def cap(df: DataFrame, contributor: Column, score: Column, ordinal: str, share: float | None = None, count: int | None = None, most_broadcast: int = BROADCAST_ROWS) -> DataFrame:
    """ordinal, _contributor and keep (boolean) for every row of df.

    Each contributor keeps its best `count` rows, or ceil(share * all rows of df): highest score first, null and NaN
    last, ties by smaller ordinal, null ordinals last. Rows without a contributor are kept and count among all rows. Only
    contributors over the cap take part in the selection, and no contributor's rows are sorted or gathered. Rows equal
    in score and ordinal cannot be told apart: they are kept or dropped together, which never keeps fewer than the cap.
    An empty table gives no rows.
    """
    scratch = Scratch(df.sparkSession)
    rows = scratch.save(df.select(
        contributor.alias("_contributor"), F.col(ordinal).cast("long").alias(ordinal),
        radix.descending_double(score).alias("_c0"), radix.ascending_long(F.col(ordinal)).alias("_c1"),
    ))
    total = rows.count()
    if count is None:
        from decimal import ROUND_CEILING, Decimal

        # the share as it is written, so that 0.03 of 20000 is 600 and not 601
        count = int((Decimal(repr(float(share))) * total).to_integral_value(ROUND_CEILING))
    sizes = rows.where("_contributor IS NOT NULL").groupBy("_contributor").agg(F.count(F.lit(1)).alias("_n"))
    over = scratch.save(sizes.where(F.col("_n") > count))
    n_over = over.count()
    if not n_over or count < 1:
        keep = F.col("_contributor").isNull() | F.lit(count >= 1)
        return rows.select(ordinal, "_contributor", keep.alias("keep"))
    small = n_over <= most_broadcast  # a share bounds it by 1 / share; a count may not
    hot = None if small else hot_keys(over, "_contributor", "_n", total)
    cut = radix.cutoffs(rows, over.select("_contributor", F.lit(count).cast("long").alias("_need")), "_contributor", ["_c0", "_c1"], broadcast=small, hot=hot, scratch=scratch)
    if small:
        both = rows.join(F.broadcast(cut), "_contributor", "left")
    else:
        both = salted_join(rows, cut, "_contributor", hot, F.col(ordinal), "left")
    return both.select(ordinal, "_contributor", (F.col("_p0").isNull() | radix.not_beyond(["_c0", "_c1"])).alias("keep"))
