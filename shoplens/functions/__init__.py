"""Column expressions built from Spark's own functions (no Python UDFs).

Every helper returns a ``Column`` that stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "comma_list", "pct1", "whole_pct", "is_click", "has_list", "action_kind",
    "pairs_json", "time_ms",
]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def comma_list(c) -> Column:
    """Split a comma list like the JVM's ``String.split(",")``.

    Trailing empty items are dropped (``'1,2,,'`` -> ``['1','2']``, ``','``
    -> ``[]``); inner empty items and duplicates stay; a string without any
    comma is a one-item list; null stays null. Spark's ``split`` keeps the
    trailing empties, hence the ``regexp_replace`` first.
    """
    s = _c(c)
    trimmed = F.regexp_replace(s, ",+$", "")
    return (F.when(s.isNull(), F.lit(None).cast("array<string>"))
            .when((trimmed == "") & (s != ""), F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, ",")))


def pct1(n, total) -> Column:
    """Percent with one decimal: ``round(1000.0 * n / total) / 10`` (DOUBLE).

    Null when ``total`` is 0 (no division-by-zero failure under ANSI).
    ``round`` is half-up, equal to the JVM's ``Math.round`` for n >= 0.
    """
    ratio = F.try_divide(F.lit(1000.0) * _c(n).cast("double"), _c(total).cast("double"))
    return F.round(ratio) / F.lit(10.0)


def whole_pct(n, total) -> Column:
    """Whole percent as DOUBLE: ``Math.round(n / total * 1000) / 10`` with a
    Long division, so 45.67 % gives 45.0 (the city remark's arithmetic)."""
    ratio = F.try_divide(_c(n).cast("double"), _c(total).cast("double")) * F.lit(1000.0)
    return F.floor(F.round(ratio) / F.lit(10)).cast("double")


def is_click(c="click_category_id") -> Column:
    return _c(c) != F.lit(-1)


def has_list(c) -> Column:
    """A comma-list column that holds something (not null, not empty)."""
    s = _c(c)
    return s.isNotNull() & (F.length(s) > 0)


def action_kind(search="search_keyword", click_product="click_product_id",
                order_products="order_product_ids", pay_products="pay_product_ids") -> Column:
    """Kind of a visit action for the session summary: the first match wins.

    search if a keyword is set, else click if a product was clicked, else
    order / pay if that list is not null (an empty list still counts here).
    """
    return (F.when(_c(search).isNotNull(), F.lit("search"))
            .when(_c(click_product) != F.lit(-1), F.lit("click"))
            .when(_c(order_products).isNotNull(), F.lit("order"))
            .when(_c(pay_products).isNotNull(), F.lit("pay")))


def pairs_json(pairs) -> Column:
    """Render an array of ``struct(k, v)`` as ``[{"k1":v1},{"k2":v2}]``.

    The key is turned into a string; the order of the array is kept.
    """
    return F.to_json(F.transform(_c(pairs), lambda p: F.create_map(
        p.getField("k").cast("string"), p.getField("v"))))


def time_ms(text) -> Column:
    """Epoch milliseconds of a ``yyyy-MM-dd HH:mm:ss`` string read as UTC.

    Unparsable text gives null rather than failing the job.
    """
    ts = F.try_to_timestamp(_c(text), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.unix_seconds(ts) * F.lit(1000)
