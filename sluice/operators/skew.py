"""A join that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT = 1024


def hot_among(counts: DataFrame, keys: list[str], count_col: str, total: int, floor: int = 1_000_000) -> DataFrame:
    """Keys with more rows than ``floor`` and than one ``MAX_HOT``-th of ``total``.

    The second bound means at most ``MAX_HOT`` keys can qualify, whatever the
    data holds.
    """
    return counts.filter(F.col(count_col) > max(floor, total // MAX_HOT)).select(*keys)


def hot_keys(df: DataFrame, keys: list[str], floor: int = 1_000_000) -> DataFrame:
    """Hot keys of a table; counts combine before their shuffle."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return hot_among(counts, keys, "_rows", df.count(), floor)


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    how: str = "inner",
    *,
    salts: int = 64,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join ``left`` with ``right`` (few rows per key), hot keys salted.

    Without ``hot`` the join is left to adaptive execution, which splits skewed
    partitions of a shuffled join by itself. With ``hot`` (see ``hot_keys``; at
    most ``MAX_HOT`` rows, so broadcasting it is bounded) rows of those keys
    are spread over ``salts`` partitions and the matching right rows repeated.
    """
    if hot is None:
        return left.join(right, keys, how)
    marked = F.broadcast(hot.select(*keys).withColumn("_hot", F.lit(True)))
    rest = [F.col(c) for c in left.columns if c not in keys]
    spread = F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int") if rest else F.lit(0)
    is_hot = F.coalesce(F.col("_hot"), F.lit(False))
    left = left.join(marked, keys, "left").withColumn("_salt", F.when(is_hot, spread).otherwise(0)).drop("_hot")
    all_salts = F.array(*[F.lit(i) for i in range(salts)])
    right = (
        right.join(marked, keys, "left")
        .withColumn("_salt", F.explode(F.when(is_hot, all_salts).otherwise(F.array(F.lit(0)))))
        .drop("_hot")
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
