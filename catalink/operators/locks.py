"""Lock levels of missing titles, and the curated rows that they give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L
from ..functions.text import lock_level
from .ingest import last_of, scanned


def routed(missing: DataFrame, info: DataFrame) -> DataFrame:
    """Missing titles with route (not_returned, open, create_locked, read_locked, unknown) and looked-up page_id.

    Of several answers for one title the last one counts."""
    found = last_of(info, "title", "allevel", "page_id").withColumn("returned", F.lit(True))
    rows = scanned(missing).select(F.col("id").alias("upstream_id"), "title").join(found, "title", "left")
    route = F.when(F.col("returned").isNull(), "not_returned").otherwise(lock_level(F.col("allevel")))
    return rows.select("upstream_id", "title", route.alias("route"), "page_id")


def route_counts(routes: DataFrame) -> DataFrame:
    return routes.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def to_blocked(routes: DataFrame) -> DataFrame:
    """Rows for the blocked titles: those locked against creation."""
    return routes.filter("route = 'create_locked'").select("title", "upstream_id", F.lit(L.REASON_CREATE_LOCK).alias("reason"))


def to_manual(routes: DataFrame) -> DataFrame:
    """Rows for the manual matches: those locked against reading."""
    return routes.filter("route = 'read_locked'").select(
        F.col("page_id").alias("local_page_id"), F.col("upstream_id").alias("upstream_page_id"), F.lit(L.REASON_READ_LOCK).alias("reason")
    )


def added(curated: DataFrame, new: DataFrame, key: str, now: Column) -> DataFrame:
    """The curated table with the new rows put in by ``key``; the date of an existing row stays, a new row gets ``now``."""
    dates = curated.select(F.col(key).alias("_key"), F.col("added_at").alias("_added"), F.lit(True).alias("_known"))
    dated = F.when(F.col("_known"), F.col("_added")).otherwise(now)
    stamped = new.join(dates, new[key] == F.col("_key"), "left").withColumn("added_at", dated).select(*curated.columns)
    return curated.join(new.select(key), key, "left_anti").select(*curated.columns).unionByName(stamped)
