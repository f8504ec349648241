"""Ad lines with faults by a rule, the input of the registered parser query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def odd_ad_lines(clicks: DataFrame) -> DataFrame:
    """The clicks (with ``event_id``) as wire lines, some of them odd by a rule on the id.

    Of every 16 ids: one line lacks the ad, one has a text ts, one overflows a
    bigint, one lies beyond year 9999, one has a sixth field, one an empty area,
    one trailing spaces; text, zero-padded and long ids occur too.
    """
    text = lambda c: F.regexp_replace(F.col(c), " ", "_")
    kind = F.col("event_id") % 16
    ms = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    ts = (F.when(kind == 1, "x").when(kind == 2, "9223372036854775807").when(kind == 3, "92233720368547758079")
          .when(kind == 4, "253402300800000").when(kind == 5, F.concat(F.lit("+"), ms)).otherwise(ms))
    user = F.when(kind == 6, F.concat(F.lit("u"), text("user_id"))).when(kind == 7, F.concat(F.lit("00"), text("user_id"))).otherwise(text("user_id"))
    ad = F.when(kind == 8, "9999999999").when(kind == 9, F.concat(F.lit("ad-"), text("ads_id"))).otherwise(text("ads_id"))
    area = F.when(kind == 10, "").otherwise(text("area"))
    tail = F.when(kind == 11, " sixth field").when(kind == 12, "   ").otherwise("")
    whole = F.concat(F.concat_ws(" ", ts, area, text("city"), user, ad), tail)
    return clicks.select("event_id", F.when(kind == 0, F.concat_ws(" ", ts, area, text("city"), user)).otherwise(whole).alias("value"))
