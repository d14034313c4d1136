"""Joining per-group values back to rows when some groups are very large."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

HOT_GROUPS = 1024
SALTS = 4096


def attach_group_values(
    rows: DataFrame,
    groups: DataFrame,
    key: str,
    size_col: str,
    row_key: str,
    hot_groups: int = HOT_GROUPS,
) -> DataFrame:
    """Left join of ``rows`` with ``groups`` on ``key``, safe for hot keys.

    ``groups`` holds the row count of its group in ``size_col``. The ``hot_groups``
    largest groups are broadcast, values included, so the broadcast side never
    exceeds that many rows of modest width and every remaining group holds at most
    ``1 / hot_groups`` of all rows. Rows already answered by the broadcast carry a
    salt that spreads them over the shuffle of the second join. Null is a key like
    any other. A key that ``groups`` repeats, with the same size, gives a row for each:
    the last key of the largest ones may go on behind the limit and is left to the
    second join.
    """
    values = [c for c in groups.columns if c != key]
    largest = [F.desc(size_col), F.asc(key)]
    top, every = Window.orderBy(*largest), Window.partitionBy()
    hot = groups.orderBy(*largest).limit(hot_groups)
    hot = hot.withColumns({"_place": F.dense_rank().over(top), "_rows": F.count(F.lit(1)).over(every)})
    hot = hot.withColumn("_last", F.max("_place").over(every))
    hot = hot.filter((F.col("_rows") < hot_groups) | (F.col("_place") < F.col("_last")))
    hot = hot.select(
        F.col(key).alias("_hot_key"), F.lit(True).alias("_hot"), *[F.col(c).alias(f"_hot_{c}") for c in values]
    )
    # The salt of the second side is always 0, written so that it stays a join key.
    cold = groups.select(
        F.col(key).alias("_cold_key"),
        F.when(F.col(size_col) < 0, 1).otherwise(0).alias("_cold_salt"),
        *[F.col(c).alias(f"_cold_{c}") for c in values],
    )
    spread = F.pmod(F.xxhash64(F.col(row_key)), F.lit(SALTS)).cast("int") + 1
    salted = rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col("_hot_key")), "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0))
    )
    same = F.col(key).eqNullSafe(F.col("_cold_key")) & (F.col("_salt") == F.col("_cold_salt"))
    joined = salted.join(cold, same, "left")
    return joined.select(
        *[F.col(c) for c in rows.columns],
        *[
            F.when(F.col("_hot"), F.col(f"_hot_{c}")).otherwise(F.col(f"_cold_{c}")).alias(c)
            for c in values
        ],
    )
