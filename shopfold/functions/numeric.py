"""Rounding and line totals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Above 2^52 every double is already an integer, so floor is the identity there.
_EXACT_INT_LIMIT = 4503599627370496.0


def js_round2(x: Column) -> Column:
    """``Math.round(x * 100) / 100`` as ``floor(x*100 + 0.5) / 100``.

    Not Spark's ``round`` (HALF_UP on the decimal value): 1.005 gives 1.0 here,
    -2.5 rounds toward +inf.  ``floor`` of a double returns BIGINT in Spark, so it
    is applied only where the result is exact and cast back to double.
    """
    y = x * F.lit(100.0) + F.lit(0.5)
    fl = F.when(F.abs(y) < F.lit(_EXACT_INT_LIMIT), F.floor(y).cast("double")).otherwise(y)
    return fl / F.lit(100.0)


def js_round2_sql(x: str) -> str:
    """SQL text of :func:`js_round2` for expression ``x`` (used in staged projections)."""
    y = f"(({x}) * 100.0D + 0.5D)"
    return (f"(CASE WHEN abs({y}) < {_EXACT_INT_LIMIT}D THEN CAST(floor({y}) AS DOUBLE) "
            f"ELSE {y} END / 100.0D)")


def line_total(platform: Column, item_total: Column, price: Column, qty: Column) -> Column:
    """product_total before rounding, per platform.

    WooCommerce reports the line total; GoMag multiplies the *unrounded* price by
    the quantity; MerchantPro takes the subtotal and falls back to price x qty
    when the subtotal is 0 (`||`).
    """
    return (F.when(platform == "woocommerce", item_total)
            .when(platform == "merchantpro",
                  F.when(item_total != 0, item_total).otherwise(price * qty))
            .otherwise(price * qty))
