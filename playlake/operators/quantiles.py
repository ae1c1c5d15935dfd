"""Quantiles that roll up, and exact ones found with their help.

``quantile_sketches`` keeps a KLL sketch for each group, ``rolled_up`` merges them to coarser
groups without a look at the rows. A sketch's quantile may be off by some ranks
(``RANK_ERROR`` for ``K``); where the exact value is wanted, ``exact_quantiles`` takes the
band of values that the sketch leaves open and counts only in there, so no group's values
are gathered: outside the band they are added up, inside they are grouped by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Size of a sketch; a quantile's rank is off by more than 0.02 in about one of 1,000 cases.
K, RANK_ERROR = 200, 0.02
SKETCH = "sketch"
#: Half the band that ``exact_quantiles`` counts in: well beyond the error.
BAND = 0.04


def quantile_sketches(rows: DataFrame, keys: list[str], value: str, k: int = K) -> DataFrame:
    """keys, rows and the sketch of the non-null values of each group."""

    return rows.groupBy(*keys).agg(
        F.count(value).alias("values"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias(SKETCH)
    )


def rolled_up(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """The sketches of coarser groups, from those of finer ones."""

    return sketches.groupBy(*keys).agg(F.sum("values").alias("values"), F.kll_merge_agg_double(SKETCH).alias(SKETCH))


def estimates(sketches: DataFrame, keys: list[str], probabilities: list[float]) -> DataFrame:
    """keys, probability and the sketch's value for it; groups without a value have none."""

    points = F.array(*[
        F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(p))).alias("estimate"))
        for p in probabilities
    ])
    return sketches.where("values > 0").select(*keys, F.inline(points))


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, probabilities: list[float], sketches: DataFrame) -> DataFrame:
    """keys, probability, values (number of them) and exact: the least value that at least this
    part of the group's values does not exceed (``percentile_disc``).

    ``sketches`` are those of the same groups. ``rows`` is read twice, ``sketches`` too: pass
    written tables. A band that misses its quantile (its counts tell) is widened to all.
    """

    inf = float("inf")
    at = lambda x: F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(x)))
    points = F.array(*[
        F.struct(
            F.lit(float(p)).alias("probability"),
            (at(p - BAND) if p > BAND else F.lit(-inf)).alias("low"),
            (at(p + BAND) if p < 1 - BAND else F.lit(inf)).alias("high"),
        )
        for p in probabilities
    ])
    bands = sketches.where("values > 0").select(*keys, "values", F.inline(points))
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    condition = on[0]
    for x in on[1:]:
        condition &= x
    named = lambda df: df.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in df.columns if c not in keys])
    found = _counted(rows, keys, value, bands, condition, named)
    missed = found.where("exact IS NULL")
    if missed.isEmpty():
        return found
    wide = bands.withColumns({"low": F.lit(-inf), "high": F.lit(inf)})
    return _counted(rows, keys, value, wide, condition, named)


def _counted(rows: DataFrame, keys: list[str], value: str, bands: DataFrame, condition, named) -> DataFrame:
    """Values below each band as one count, those inside by value, and the one at the rank."""

    v = F.col(value).cast("double")
    joined = rows.where(F.col(value).isNotNull()).select(*keys, v.alias("_v")).join(named(bands), condition)
    joined = joined.where(F.col("_v") <= F.col("high"))
    inside = F.when(F.col("_v") >= F.col("low"), F.col("_v"))  # null: all that is below, first in order
    cells = joined.groupBy(*keys, "probability", "values", inside.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*keys, "probability").orderBy(F.col("_v").asc_nulls_first()))
    rank = F.greatest(F.ceil(F.col("probability") * F.col("values")), F.lit(1))
    cells = cells.withColumn("_upto", upto).withColumn("_rank", rank)
    # a band that begins or ends beyond the rank gives no value
    at_rank = (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank"))
    return cells.groupBy(*keys, "probability", "values").agg(F.max(F.when(at_rank, F.col("_v"))).alias("exact"))
