"""Schemas of the shop's tables (inputs) and of the question results (outputs).

Column names are snake_case versions of the reference's; comma lists stay
strings at the edge and are split inside the operators.
"""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, I, D = StringType(), LongType(), IntegerType(), DoubleType()

USER_VISIT_ACTION = _s(
    ("date", S), ("user_id", L), ("session_id", S), ("page_id", L), ("action_time", S),
    ("search_keyword", S), ("click_category_id", L), ("click_product_id", L),
    ("order_category_ids", S), ("order_product_ids", S), ("pay_category_ids", S),
    ("pay_product_ids", S), ("city_id", L), ("event_id", L))
USER_INFO = _s(("user_id", L), ("username", S), ("name", S), ("age", I), ("professional", S),
               ("gender", S))
PRODUCT_INFO = _s(("product_id", L), ("product_name", S), ("extend_info", S))
CITY_INFO = _s(("city_id", L), ("city_name", S), ("area", S))
# The given tables that the shop's tables are derived from.
GIVEN_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}
ADS_LINE = _s(("value", S))

SESSION_STAT_INFO = _s(
    ("task_id", S), ("conditions", S), ("session_count", L), ("visit_length_gt_10_ratio", D),
    ("visit_length_le_10_ratio", D), ("step_length_gt_5_ratio", D), ("step_length_le_5_ratio", D))
RANDOM_SESSION_INFO = _s(
    ("task_id", S), ("session_id", S), ("start_time", S), ("step_length", L),
    ("visit_length", L), ("search_keywords", S), ("click_product_ids", S),
    ("order_product_ids", S), ("pay_product_ids", S))
CATEGORY_TOP10 = _s(("task_id", S), ("category_id", S), ("click_count", L), ("order_count", L),
                    ("pay_count", L))
CATEGORY_TOP10_SESSION_COUNT = _s(("task_id", S), ("category_id", S), ("session_id", S),
                                  ("click_count", L))
PAGE_CONVERT_RATE = _s(("task_id", S), ("page_jump", S), ("rate", D))
AREA_TOP3_PRODUCT = _s(("area", S), ("product_id", L), ("product_name", S), ("clickcount", L),
                       ("cityremark", S))


def names(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields]
