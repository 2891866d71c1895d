"""The curated tables: runs that feed back into them until nothing is new, and upserts that rewrite only what they touch."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import locks, matching
from .counters import Counters
from .work import saved

#: Buckets of a stored curated table.
BUCKETS = 64


@dataclass
class Rounds:
    """``log``: round, missing, new_blocked, new_manual; ``converged``: the last round added nothing."""

    manual: DataFrame
    blocked: DataFrame
    log: DataFrame
    converged: bool


def rounds(rows: DataFrame, upstream: DataFrame, manual: DataFrame, blocked: DataFrame, info: DataFrame, most: int = 20) -> Rounds:
    """Runs one after the other, each with the curated rows that the locks of the one before gave.

    A link that a run adds may take a local page from its former target, which is missing in the next run. What doesn't depend on curated rows is
    made once: what each of the ``rows`` (from ``matching.prepared``) refers to, which links have a target, and the lock of each upstream title; a round joins ids alone. A
    round's new rows are those that the tables don't have yet, and the rounds end when there are none. Two pages that are locked for reading and name one local page would
    take it from each other for ever: so ``most`` bounds the rounds. Within a round the smallest upstream id gets the local page."""
    manual = manual.select("local_page_id", "upstream_page_id")
    blocked = blocked.select("title")
    refs = saved(matching.references(rows), "references")
    links = matching.targets(manual, upstream)
    locked = saved(_locked(upstream.join(blocked, "title", "left_anti"), info), "locked")
    shut_before = None
    log: list[tuple[int, int, int, int]] = []
    while len(log) < most:
        counters = Counters()
        missing = locked.join(matching.referred(refs, links), "id", "left_anti")
        if shut_before is not None:
            # of the titles that runs have blocked all are locked against creation, and no others have a value here
            missing = missing.join(shut_before, "shut", "left_anti")
        missing = counters.written(missing, "missing", missing=F.count(F.lit(1)))
        shut = counters.written(missing.filter("shut is not null").select("shut").distinct(), "blocked", new_blocked=F.count(F.lit(1)))
        taken = missing.filter("page_id is not null").groupBy(F.col("page_id").alias("local_page_id")).agg(F.min("id").alias("upstream_page_id"))
        taken = counters.written(taken.join(manual, ["local_page_id", "upstream_page_id"], "left_anti"), "links", new_manual=F.count(F.lit(1)))
        n = counters.counts()
        log.append((len(log) + 1, n["missing"], n["new_blocked"], n["new_manual"]))
        if not n["new_blocked"] and not n["new_manual"]:
            break
        blocked = blocked.unionByName(shut.withColumnRenamed("shut", "title"))
        shut_before = shut if shut_before is None else saved(shut_before.unionByName(shut), "shut")
        # a page that was missing is an upstream page, so a new link has its target
        new = taken.withColumn("exists", F.lit(True))
        links = saved(links.join(taken.select("local_page_id"), "local_page_id", "left_anti").unionByName(new.select(*links.columns)), "manual")
        manual = links.select("local_page_id", "upstream_page_id")
    names = ("round", "missing", "new_blocked", "new_manual")
    table = rows.sparkSession.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(names, r, strict=True)]) for r in log])))
    return Rounds(manual, blocked, table, not any(log[-1][2:]))


def _locked(upstream: DataFrame, info: DataFrame) -> DataFrame:
    """(id, shut, page_id) of upstream pages: the title if it is locked against creation, the local page if it is locked against reading."""
    routes = locks.routed(upstream, info)
    locked = routes.select(
        F.col("upstream_id").alias("id"), F.when(F.col("route") == "create_locked", F.col("title")).alias("shut"), F.when(F.col("route") == "read_locked", F.col("page_id")).alias("page_id")
    )
    # pages that a scan doesn't see have no route, but may be missing
    unseen = upstream.filter(~(F.coalesce("id", F.lit(0)) > 0)).select("id", F.lit(None).cast("string").alias("shut"), F.lit(None).cast("long").alias("page_id"))
    return locked.unionByName(unseen)


def _bucket(key: str) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def bucketed(table: DataFrame, path: str, key: str) -> None:
    """Writes a table in folders by the hash of its key."""
    table.withColumn("bucket", _bucket(key)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("bucket")


def upsert_buckets(spark: SparkSession, path: str, arriving: DataFrame, key: str, keep: tuple[str, ...] = ()) -> None:
    """Puts rows in by ``key``; an existing row keeps the columns ``keep``. Only buckets of arriving keys are read and rewritten.

    Of several arriving rows of a key the one with the largest values counts. The new buckets are written beside the table before they take
    the place of the old ones, as a table can't be overwritten while it is read."""
    columns = [c for c in spark.read.parquet(path).columns if c != "bucket"]
    values = F.struct(*[c for c in columns if c != key])
    arriving = saved(arriving.select(*columns).groupBy(key).agg(F.max(values).alias("_v")).select(key, "_v.*").select(*columns).withColumn("bucket", _bucket(key)), "arriving")
    touched = [r.bucket for r in arriving.select("bucket").distinct().collect()]  # at most BUCKETS
    if not touched:
        return
    old = spark.read.parquet(path).filter(F.col("bucket").isin(touched))
    former = old.select(key, *[F.col(c).alias(f"_{c}") for c in keep], F.lit(True).alias("_known"))
    new = arriving.join(former, key, "left").withColumns({c: F.when(F.col("_known"), F.col(f"_{c}")).otherwise(F.col(c)) for c in keep}).select(*columns, "bucket")
    rest = old.join(arriving.select(key), key, "left_anti").select(*columns, "bucket")
    written = saved(rest.unionByName(new), "buckets")
    written.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
