"""Promotion uplift tables from per-family coefficients."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.columns import uplift_pct


def promo_uplift(coefs: DataFrame) -> DataFrame:
    """Absolute and relative uplift on normal days, weekends and holidays, and the largest."""
    absolute = {
        "normal": F.col("coef_promo"),
        "weekend": F.col("coef_promo") + F.col("coef_promo_weekend"),
        "holiday": F.col("coef_promo") + F.col("coef_promo_holiday"),
    }
    table = coefs.withColumns({f"uplift_{k}_abs": c for k, c in absolute.items()})
    table = table.withColumns(
        {f"uplift_{k}_pct": uplift_pct(F.col(f"uplift_{k}_abs"), F.col("mean_sale")) for k in absolute}
    )
    return table.withColumn("uplift_max_pct", F.greatest(*[f"uplift_{k}_pct" for k in absolute])).select(
        "family", "segment", "mean_sale", "coef_promo", "coef_promo_weekend", "coef_promo_holiday",
        *[f"uplift_{k}_abs" for k in absolute], *[f"uplift_{k}_pct" for k in absolute], "uplift_max_pct",
    )


def promo_elasticity(coefs: DataFrame) -> DataFrame:
    """(mean_sale, promo_uplift_pct) per family: the plain ratio, null without sales."""
    pct = F.try_divide(F.col("coef_promo"), F.col("mean_sale")) * 100
    return coefs.select("family", "segment", "mean_sale", "coef_promo", pct.alias("promo_uplift_pct"))
