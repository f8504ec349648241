"""Shared names of the tests: folders, small hand-made frames, collected rows."""

import os

from pyspark.sql import types as T

from shoplens import schemas

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Collect a small result as sorted tuples (tests only)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


ACTION_SCHEMA = T.StructType([T.StructField("event_id", T.LongType())] + schemas.USER_VISIT_ACTION.fields)

_DEFAULT = dict(date=None, user_id=1, session_id="s1", page_id=1, action_time="2024-01-05 10:00:00",
                search_keyword=None, click_category_id=-1, click_product_id=-1,
                order_category_ids=None, order_product_ids=None, pay_category_ids=None,
                pay_product_ids=None, city_id=1)


def actions(spark, *specs):
    """Build an action log; each spec overrides the defaults; event ids count up."""
    out = []
    for i, spec in enumerate(specs):
        row = dict(_DEFAULT, **spec)
        if row["date"] is None:
            row["date"] = row["action_time"][:10]
        row.setdefault("event_id", i)
        row["event_id"] = spec.get("event_id", i)
        out.append(tuple(row[f.name] for f in ACTION_SCHEMA.fields))
    return spark.createDataFrame(out, ACTION_SCHEMA)


def users(spark, *pairs):
    """(user_id, age) pairs -> user_info frame."""
    return spark.createDataFrame([(u, f"u{u}", f"u{u}", a, "p", "M") for u, a in pairs], schemas.USER_INFO)


def cities(spark, *triples):
    return spark.createDataFrame(list(triples), schemas.CITY_INFO)


def products(spark, *pairs):
    return spark.createDataFrame([(p, n, "x") for p, n in pairs], schemas.PRODUCT_INFO)


CLICK_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("area", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ads_id", T.StringType()),
])


def clicks(spark, *specs):
    """Ad clicks from (ts text, user, ad[, area, city]) specs; event ids count up."""
    import datetime as dt

    out = []
    for i, s in enumerate(specs):
        ts, user, ad = s[:3]
        area = s[3] if len(s) > 3 else "A"
        city = s[4] if len(s) > 4 else "c1"
        out.append((i, dt.datetime.fromisoformat(ts), area, city, str(user), str(ad)))
    return spark.createDataFrame(out, CLICK_SCHEMA)
