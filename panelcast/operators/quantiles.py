"""Exact group quantiles that never hold a group's values in one task.

The built-in exact percentile keeps every distinct value of a group in one hash map,
which a family with a third of all rows would not fit. Here a bounded sketch brackets
the two order statistics that matter, the values inside the bracket are counted, and
only those few are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import clip_upper, join_null_safe
from panelcast.operators.ranking import RANGE_ROWS, running_total
from panelcast.session import materialize

BELOW, INSIDE, ABOVE = 0, 1, 2


def exact_quantile(df: DataFrame, by: list[str], columns: list[str], q: float,
                   accuracy: int = 10_000) -> DataFrame:
    """One row per group with the linearly interpolated quantile of each column."""
    return exact_quantiles(df, by, {c: (c, q) for c in columns}, accuracy)


def exact_quantiles(df: DataFrame, by: list[str], wanted: dict[str, tuple[str, float]],
                    accuracy: int = 10_000, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``wanted`` maps an output name to (column, quantile).

    Two passes over ``df``, so hand in a materialized table. Nulls are skipped; a
    column without values gives null.
    """
    keys = [*by, "__all"]
    sources = list(dict.fromkeys(c for c, _ in wanted.values()))
    rows = df.withColumn("__all", F.lit(1)).select(*keys, *[F.col(c).cast("double").alias(c) for c in sources])

    # A sketch answers with a rank error of n/accuracy; twice that is a safe bracket.
    margin = 2.0 / accuracy

    def bracket(c: str, q: float) -> Column:
        ends = [max(0.0, q - margin), min(1.0, q + margin)]
        return F.struct(F.count(c).alias("n"), F.percentile_approx(c, ends, accuracy).alias("b"))

    sketch = materialize(
        rows.groupBy(*keys).agg(*[bracket(c, q).alias(f"__s_{name}") for name, (c, q) in wanted.items()]),
        "quantile_bracket",
    )

    names = list(wanted)

    def cell(at: int, name: str, c: str) -> Column:
        value, lo, hi = F.col(c), F.col(f"__s_{name}.b")[0], F.col(f"__s_{name}.b")[1]
        zone = F.when(value < lo, BELOW).when(value > hi, ABOVE).otherwise(INSIDE)
        return F.struct(F.lit(at).alias("at"), zone.alias("zone"),
                        F.when(zone == INSIDE, value).alias("inside"), value.alias("value"))

    # Ties and everything outside the bracket collapse map side.
    counted = (
        join_null_safe(rows, sketch, keys)
        .select(*by, F.explode(F.array(*[cell(i, n, wanted[n][0]) for i, n in enumerate(names)])).alias("c"))
        .select(*by, "c.*")
        .where("value is not null")
        .groupBy(*by, "at", "zone", "inside")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("value").alias("lowest"), F.max("value").alias("highest"))
    )

    # Ranks run over the bracket only: one row for all below, the distinct values inside,
    # one row for all above. The lowest value orders them.
    sizes = sketch.select("__all", *by, F.posexplode(F.array(*[F.col(f"__s_{n}.n") for n in names])).alias("at", "n"))
    levels = F.array(*[F.lit(float(wanted[n][1])) for n in names])
    upto = running_total(materialize(counted, "quantile_values"), [*by, "at"], "lowest", F.col("rows"), "upto", range_rows)
    position = (F.col("n") - 1) * levels[F.col("at")]
    ranked = (
        join_null_safe(upto.withColumn("__all", F.lit(1)), sizes, [*keys, "at"])
        .select("*", (F.col("upto") - F.col("rows")).alias("first"), (F.col("upto") - 1).alias("last"))
        .withColumns({"position": position, "lo_rank": F.floor(position), "hi_rank": F.ceil(position)})
    )

    def order_statistic(rank: str) -> Column:
        """Value at a rank; just outside the bracket it is the nearest value there."""
        hit = F.col(rank).between(F.col("first"), F.col("last"))
        value = (
            F.when(F.col("zone") == INSIDE, F.col("inside"))
            .when((F.col("zone") == BELOW) & (F.col(rank) == F.col("last")), F.col("highest"))
            .when((F.col("zone") == ABOVE) & (F.col(rank) == F.col("first")), F.col("lowest"))
            .otherwise(F.raise_error(F.lit("quantile bracket missed; raise accuracy")).cast("double"))
        )
        return F.max(F.when(hit, value))

    picked = ranked.groupBy(*by, "at").agg(
        order_statistic("lo_rank").alias("lo"),
        order_statistic("hi_rank").alias("hi"),
        F.max(F.col("position") - F.col("lo_rank")).alias("part"),
    )
    quantile = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part")
    return picked.groupBy(*by).agg(
        *[F.max(F.when(F.col("at") == i, quantile)).alias(name) for i, name in enumerate(names)]
    )


def clip_outliers(train: DataFrame, q: float = 0.99, floor: float = 10.0, by: list[str] = ("family",),
                  value: str = "sales", keep_cap: bool = False) -> DataFrame:
    """Cap values at their group's quantile, the cap being at least ``floor``."""
    caps = exact_quantile(train, list(by), [value], q).select(
        *by, F.greatest(F.col(value), F.lit(floor)).alias("cap")
    )
    capped = train.join(materialize(caps, "caps"), list(by), "left").withColumn(value, clip_upper(value, "cap"))
    return capped if keep_cap else capped.drop("cap")


def target_scale(df: DataFrame, q: float = 0.95, floor: float = 1.0, value: str = "sales") -> DataFrame:
    """The scale of the target: its quantile over all rows, at least ``floor``."""
    return exact_quantile(df, [], [value], q).select(F.greatest(F.col(value), F.lit(floor)).alias("scale"))


def fit_median(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Exact medians per group, written so that applying them is a join of known size."""
    return materialize(exact_quantile(df, list(by), columns, 0.5), "medians")


def apply_median(df: DataFrame, medians: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Fill nulls with the fitted median of the row's group."""
    table = medians.select(*by, F.lit(1).alias("__all"), *[F.col(c).alias(f"__m_{c}") for c in columns])
    joined = df.withColumn("__all", F.lit(1)).join(table, [*by, "__all"], "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in columns}).drop(
        "__all", *[f"__m_{c}" for c in columns]
    )


def impute_median(df: DataFrame, columns: list[str], by: list[str] = (), fit_on: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the exact median of the group (of ``fit_on`` where given)."""
    return apply_median(df, fit_median(df if fit_on is None else fit_on, columns, by), columns, by)
