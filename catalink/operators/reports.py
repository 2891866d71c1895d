"""Reports on the local catalog and on what it misses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as L


def _reported(local: DataFrame) -> DataFrame:
    return local.filter(~F.col("needs_attention") & ~F.col("is_dictionary_entry"))


def possibly_deleted(local: DataFrame) -> DataFrame:
    return _reported(local).filter("maybe_deleted_upstream").select("id", "title", "status", "source_type", "match_type").orderBy("title")


def undocumented(local: DataFrame) -> DataFrame:
    rows = _reported(local).filter(F.col("status") == L.STATUS_UNDOCUMENTED)
    return rows.select("id", "title", "source_type", "upstream_id", "match_type").orderBy("title")


def tasks(local: DataFrame) -> DataFrame:
    """Both of the above with the task that they give; a possible deletion comes before an unclear status."""
    task = F.when(F.col("maybe_deleted_upstream"), L.TASK_DELETED).when(F.col("status") == L.STATUS_UNDOCUMENTED, L.TASK_STATUS)
    rows = _reported(local).withColumn("task_type", task).filter("task_type is not null")
    return rows.select("id", "title", "status", "source_type", "upstream_id", "match_type", "task_type").orderBy("task_type", "title")


def missing_locally(upstream: DataFrame, local: DataFrame, blocked: DataFrame) -> DataFrame:
    """Upstream pages (id, title, and checked_at if it is there) that no local page refers to and whose exact title isn't blocked."""
    referred = local.filter("upstream_id is not null").select(F.col("upstream_id").alias("id"))
    return upstream.join(referred, "id", "left_anti").join(blocked.select("title"), "title", "left_anti").select(*[c for c in ("id", "title", "checked_at") if c in upstream.columns]).orderBy("title")
