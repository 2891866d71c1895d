"""Ingest: keyset scans, order-dependent upserts and integrity checks as set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .work import saved


def scanned(table: DataFrame, after: int = 0) -> DataFrame:
    """What a keyset scan from ``after`` sees: ids at or below it are never read."""
    return table.filter(F.col("id") > after)


def first_page(table: DataFrame, after: int, size: int) -> DataFrame:
    """One page of a keyset scan: the ``size`` smallest ids above ``after``, then titles."""
    return scanned(table, after).orderBy("id", "title").limit(size)


def numbered(table: DataFrame, after: int = 0) -> DataFrame:
    """The rows above ``after`` with ``number``, their place in the order of id, from 0. Ids are unique, as those of a keyset scan must be."""
    return in_sequence(scanned(table, after), "id")


def in_sequence(table: DataFrame, column: str) -> DataFrame:
    """The rows with ``number``, their place in the order of a column of unique values, from 0.

    Rows are sorted over all partitions and keep their place in their own; the rows of the partitions before come from one count for each
    partition. No window holds the table."""
    rows = table.repartitionByRange(column).sortWithinPartitions(column)
    rows = saved(rows.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "numbered")
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # a row for each partition, so one small window, and a broadcast that is bounded by their number
    along = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("_before", F.sum("_n").over(along) - F.col("_n")).select("_part", "_first", "_before")
    placed = rows.join(F.broadcast(parts), "_part")
    return placed.withColumn("number", F.col("_before") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_before")


def page_requests(rows: DataFrame, size: int, after: int = 0) -> DataFrame:
    """(page, cursor, n, last): the requests of a keyset scan over numbered rows: what each asks for ids above, and the rows that it gets.

    The scan ends with the first page that isn't full, so a table of whole pages (or none) has a last request that gets nothing."""
    full = rows.groupBy(F.expr(f"number div {size}").alias("page")).agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("last"))
    asked = full.filter(F.col("n") == size).select((F.col("page") + 1).alias("page"), F.col("last").alias("cursor"))
    first = rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("page"), F.lit(after).cast("long").alias("cursor"))
    requests = asked.unionByName(first).join(full, "page", "left")
    return requests.select("page", "cursor", F.coalesce("n", F.lit(0).cast("long")).alias("n"), "last")


def paginated(rows: DataFrame, size: int, after: int = 0) -> DataFrame:
    """Numbered rows with their page, their place in it and the cursor that asks for the page."""
    placed = rows.withColumns({"page": F.expr(f"number div {size}"), "place": F.col("number") % size}).drop("number")
    return placed.join(page_requests(rows, size, after).select("page", "cursor"), "page")


def last_of(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row for each value of ``key``: the last by ``pos``; without such a column, the one with the largest values."""
    values = F.struct(*columns)
    last = F.max_by(values, F.struct("pos", values)) if "pos" in rows.columns else F.max(values)
    return rows.groupBy(key).agg(last.alias("_last")).select(key, "_last.*")


def batch_dedupe(log: DataFrame) -> DataFrame:
    """One row for each title of a batch, the last one: (batch, title, id)."""
    return log.groupBy("batch", "title").agg(F.max_by("id", "pos").alias("id"))


def upsert_fold(log: DataFrame) -> DataFrame:
    """The table after upserting the log (pos, id, title, and checked_at if it has that) in order, where a new row evicts rows with its id or title.

    A row survives iff no later row shares its id or its title. Both tests look at the raw log: two successive
    deduplications would let an evicted row evict others. Two aggregations combine before they shuffle, so an id
    or title that a third of the log repeats costs no task more than others."""
    last_of_id = log.groupBy("id").agg(F.max("pos").alias("last"))
    last_of_title = log.groupBy("title").agg(F.max("pos").alias("last"))
    by_id = log.join(last_of_id.withColumnRenamed("last", "pos"), ["id", "pos"], "left_semi")
    kept = by_id.join(last_of_title.withColumnRenamed("last", "pos"), ["title", "pos"], "left_semi")
    return kept.select("pos", "id", "title", *[c for c in ("checked_at",) if c in log.columns])


def reloaded(stored: DataFrame, arriving: DataFrame, fresh: bool) -> DataFrame:
    """The table after a load: a fresh run empties it first, a resumed one goes on from the rows that are stored.

    Stored rows have smaller places (pos) than arriving ones."""
    return upsert_fold(arriving if fresh else stored.unionByName(arriving))


def stale_collisions(table: DataFrame, arriving: DataFrame) -> DataFrame:
    """Rows of the table whose title arrives with another id: (id, title, new_id)."""
    new = arriving.select("title", F.col("id").alias("new_id"))
    return table.select("id", "title").join(new, "title").filter("id <> new_id").select("id", "title", "new_id")


def release_references(local: DataFrame, stale: DataFrame) -> DataFrame:
    """Local rows with references to stale upstream ids set to null; other columns as they were."""
    gone = stale.select(F.col("id").alias("_gone")).distinct()
    joined = local.join(gone, local["upstream_id"] == F.col("_gone"), "left")
    return joined.withColumn("upstream_id", F.when(F.col("_gone").isNull(), F.col("upstream_id"))).drop("_gone")


def upserted(target: DataFrame, source: DataFrame, key: str, kept: dict[str, object]) -> DataFrame:
    """``target`` with the rows of ``source`` inserted or updated by ``key``.

    ``kept`` names the columns that the source doesn't send: an existing row keeps its values, a new row gets the default."""
    old = target.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_{c}") for c in kept])
    joined = source.join(old, source[key] == F.col("_key"), "left")
    filled = joined.withColumns({c: F.when(F.col("_key").isNotNull(), F.col(f"_{c}")).otherwise(F.lit(v)) for c, v in kept.items()})
    untouched = target.join(source.select(key), key, "left_anti")
    return untouched.unionByName(filled.select(*target.columns))


def orphans(local: DataFrame, upstream: DataFrame) -> DataFrame:
    """Local rows whose reference names no upstream row."""
    referring = local.filter("upstream_id is not null").select("id", "upstream_id")
    return referring.join(upstream.select(F.col("id").alias("upstream_id")), "upstream_id", "left_anti")


def outside_domain(table: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows whose value isn't in the closed set."""
    return table.filter(~F.col(column).isin(*allowed))


def duplicates(table: DataFrame, column: str) -> DataFrame:
    """(value, n) of values that occur more than once."""
    return table.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


