"""Table sources.

Two ways to get the shop tables:

* ``StoredTables`` reads the four shop tables as stored parquet (or catalog
  tables), the layout a deployment writes with the sinks in ``shoplens.sinks``.
* ``FixtureTables`` derives them from the driver's fixture tables with the
  adapter of FIXTURES.md (events -> action log and ad clicks, customer -> users,
  part -> products, nation + region -> cities).  The derivation is plain column
  expressions, so it fuses into the scan stage and keeps pushdown.

Both return lazy DataFrames with an explicit schema; nothing runs here.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens import schemas
from shoplens.plans.joins import join_small


class ShopTables:
    """Interface of a table source."""

    def user_visit_action(self, date_from: str | None = None,
                          date_to: str | None = None) -> DataFrame:
        raise NotImplementedError

    def user_info(self) -> DataFrame:
        raise NotImplementedError

    def city_info(self) -> DataFrame:
        raise NotImplementedError

    def product_info(self) -> DataFrame:
        raise NotImplementedError

    def ads_click(self) -> DataFrame:
        raise NotImplementedError


class StoredTables(ShopTables):
    """Shop tables stored as ``<base>/<name>`` parquet, or as catalog tables."""

    def __init__(self, spark: SparkSession, base: str | None = None, database: str | None = None):
        self.spark, self.base, self.database = spark, base, database

    def _load(self, name: str) -> DataFrame:
        if self.base is not None:
            return self.spark.read.parquet(f"{self.base.rstrip('/')}/{name}")
        return self.spark.table(f"{self.database}.{name}" if self.database else name)

    @staticmethod
    def _normalize(df: DataFrame, schema, name: str) -> DataFrame:
        # Partition folders carry no type; discovery reads ``date=2024-01-05``
        # as a DATE.  Back to the schema's text (lossless for yyyy-MM-dd).
        have = {f.name: f.dataType for f in df.schema.fields}
        for f in schema.fields:
            if isinstance(have.get(f.name), T.DateType) and isinstance(f.dataType, T.StringType):
                df = df.withColumn(f.name, F.date_format(F.col(f.name), "yyyy-MM-dd"))
        df = schemas.check_columns(df, schema, name)
        # Extra columns (such as an ``event_id`` tie key) first, then the schema's order.
        names = [f.name for f in schema.fields]
        return df.select(*[c for c in df.columns if c not in names], *names)

    def _read(self, name: str, schema) -> DataFrame:
        return self._normalize(self._load(name), schema, name)

    def user_visit_action(self, date_from=None, date_to=None) -> DataFrame:
        df = self._load("user_visit_action")
        # ``date`` is the partition column of a stored log: bounds on the raw
        # column prune whole folders (and row groups when it is a data column).
        as_date = isinstance(dict((f.name, f.dataType) for f in df.schema.fields).get("date"), T.DateType)
        bound = (lambda v: F.lit(v).cast("date")) if as_date else F.lit
        if date_from:
            df = df.where(F.col("date") >= bound(date_from))
        if date_to:
            df = df.where(F.col("date") <= bound(date_to))
        return self._normalize(df, schemas.USER_VISIT_ACTION, "user_visit_action")

    def user_info(self) -> DataFrame:
        return self._read("user_info", schemas.USER_INFO)

    def city_info(self) -> DataFrame:
        return self._read("city_info", schemas.CITY_INFO)

    def product_info(self) -> DataFrame:
        return self._read("product_info", schemas.PRODUCT_INFO)

    def ads_click(self) -> DataFrame:
        return self._read("ads_click", schemas.ADS_CLICK)


def _ntz(text: str) -> Column:
    return F.to_timestamp_ntz(F.lit(text))


class FixtureTables(ShopTables):
    """Shop tables derived from the driver's fixture parquet (FIXTURES.md)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(schemas.FIXTURE[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def _events(self, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
        ev = self.raw("events")
        # Date bounds on the derived ``date`` text, restated on the raw
        # timestamp so that parquet row groups are skipped at the scan.
        if date_from:
            ev = ev.where(F.col("ts") >= _ntz(f"{date_from} 00:00:00"))
        if date_to:
            nxt = (_dt.date.fromisoformat(date_to) + _dt.timedelta(days=1)).isoformat()
            ev = ev.where(F.col("ts") < _ntz(f"{nxt} 00:00:00"))
        k = F.get_json_object("props", "$.k").try_cast("int")
        return ev.select("event_id", "ts", "user_id", "event_type", k.alias("k"))

    def user_visit_action(self, date_from=None, date_to=None) -> DataFrame:
        e = self._events(date_from, date_to)
        k, et = F.col("k"), F.col("event_type")
        day = F.date_format("ts", "yyyy-MM-dd")
        clicked = et.isin("click", "error")
        return e.select(
            "event_id",
            day.alias("date"),
            "user_id",
            F.concat(F.col("user_id").cast("string"), F.lit("-"), day).alias("session_id"),
            (k % 10 + 1).cast("bigint").alias("page_id"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
            F.when(et == "view", F.concat(F.lit("kw"), (k % 6).cast("string"))).alias("search_keyword"),
            F.when(clicked, k % 20 + 1).otherwise(-1).cast("bigint").alias("click_category_id"),
            F.when(clicked, k + 1).otherwise(-1).cast("bigint").alias("click_product_id"),
            F.when(et == "signup", F.concat((k % 20 + 1).cast("string"), F.lit(","),
                                            ((k + 3) % 20 + 1).cast("string"))).alias("order_category_ids"),
            F.when(et == "signup", F.concat((k + 1).cast("string"), F.lit(","),
                                            ((k + 7) % 100 + 1).cast("string"))).alias("order_product_ids"),
            F.when(et == "purchase", (k % 20 + 1).cast("string")).alias("pay_category_ids"),
            F.when(et == "purchase", (k + 1).cast("string")).alias("pay_product_ids"),
            (F.col("user_id") % 25).alias("city_id"),
        )

    def user_info(self) -> DataFrame:
        c = self.raw("customer")
        key = F.col("c_custkey")
        return c.select(
            key.alias("user_id"),
            F.col("c_name").alias("username"),
            F.col("c_name").alias("name"),
            (10 + key % 50).cast("int").alias("age"),
            F.col("c_mktsegment").alias("professional"),
            F.when(key % 5 < 3, "M").otherwise("F").alias("gender"),
        )

    def city_info(self) -> DataFrame:
        n, r = self.raw("nation"), self.raw("region")
        return join_small(n, r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").cast("bigint").alias("city_id"),
            F.col("n_name").alias("city_name"),
            F.col("r_name").alias("area"),
        )

    def product_info(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("extend_info"),
        )

    def ads_click(self) -> DataFrame:
        """Every event as an ad click: area and city from the user's city."""
        e = self._events()
        cities = self.city_info()
        joined = join_small(e, cities, (F.col("user_id") % 25) == F.col("city_id"))
        return joined.select(
            "event_id", "ts", "area",
            F.col("city_name").alias("city"),
            F.col("user_id").cast("string").alias("user_id"),
            (F.col("k") % 6 + 1).cast("string").alias("ads_id"),
        )
