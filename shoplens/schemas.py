"""Explicit schemas: the shop tables and the fixture tables they are built from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- shop tables (the reference's case classes) -------------------------------

USER_VISIT_ACTION = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("action_time", T.StringType()),
    T.StructField("search_keyword", T.StringType()),
    T.StructField("click_category_id", T.LongType()),
    T.StructField("click_product_id", T.LongType()),
    T.StructField("order_category_ids", T.StringType()),
    T.StructField("order_product_ids", T.StringType()),
    T.StructField("pay_category_ids", T.StringType()),
    T.StructField("pay_product_ids", T.StringType()),
    T.StructField("city_id", T.LongType()),
])

USER_INFO = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("username", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("professional", T.StringType()),
    T.StructField("gender", T.StringType()),
])

PRODUCT_INFO = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("extend_info", T.StringType()),
])

CITY_INFO = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("area", T.StringType()),
])

# One ad click; ``ts`` is an event timestamp (epoch ms on the wire), ids are text.
ADS_CLICK = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ads_id", T.StringType()),
])

# --- fixture tables read from parquet -----------------------------------------

FIXTURE = {
    "events": T.StructType([
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]),
    "part": T.StructType([
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()),
        T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()),
        T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ]),
    "region": T.StructType([
        T.StructField("r_regionkey", T.IntegerType()),
        T.StructField("r_name", T.StringType()),
    ]),
}


def check_columns(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """Fail early, on the driver, when a required column is missing or mistyped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in have:
            raise ValueError(f"{name}: missing column {f.name!r}")
        if have[f.name] != f.dataType:
            raise ValueError(f"{name}: column {f.name!r} is {have[f.name].simpleString()}, "
                             f"expected {f.dataType.simpleString()}")
    return df
