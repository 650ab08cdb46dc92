"""What became of fetching pages, from a table of attempts: retries, cache, robots, as rules on data.

The engine fetches nothing itself. A connector that does logs its attempts; these rules say what
it should have made of them, and which pages a run may take from the cache.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Statuses that are worth another attempt, and how many there are.
RETRYABLE = [408, 429, 500, 502, 503, 504, 522, 524]
ATTEMPTS = 4


def pause(attempt: Column, retry_after: Column) -> Column:
    """Seconds before the next attempt: what the site asks for, if it is a whole number, else doubling."""
    asked = F.when(retry_after.rlike(r"^\d+$"), retry_after).try_cast("double")
    return F.coalesce(asked, F.pow(F.lit(2.0), attempt))


def outcomes(attempts: DataFrame, most: int = ATTEMPTS) -> DataFrame:
    """One row a URL from (url, attempt, status, retry_after): the attempt that settled it, its status,
    how many were made, how long they paused, and ``error`` where all failed.

    A null status is a connection that broke. A status that isn't retryable settles a page, an
    error status too; pages with ``most`` failures are given up. Later attempts never happened.
    """
    order = Window.partitionBy("url").orderBy("attempt")
    failed = F.col("status").isNull() | F.col("status").isin(RETRYABLE)
    before = F.coalesce(F.min(F.when(~failed, F.col("attempt"))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(most + 1))
    made = attempts.where(F.col("attempt") <= most).withColumns({"_failed": failed, "_settled": before}).where(F.col("attempt") < F.col("_settled"))
    broke = F.col("status").isNull()
    wait = F.when(F.col("_failed"), pause(F.col("attempt"), F.when(~broke, F.col("retry_after"))))
    last = made.groupBy("url").agg(
        F.count(F.lit(1)).alias("attempts"), F.coalesce(F.sum(wait), F.lit(0.0)).alias("paused"),
        F.max_by(F.struct("status", "_failed"), "attempt").alias("_last"),
    )
    error = F.when(F.col("_last._failed"), F.coalesce(F.concat(F.lit("HTTP "), F.col("_last.status").cast("string")), F.lit("no connection")))
    return last.select("url", F.when(~F.col("_last._failed"), F.col("_last.status")).alias("status"), "attempts", "paused", error.alias("error"))


def cacheable(outcome: DataFrame) -> DataFrame:
    """Only successes are kept, under the hash of their URL."""
    return outcome.where(F.col("error").isNull() & (F.col("status") < 400)).withColumn("cache_key", F.sha1("url"))


def answered(wanted: DataFrame, cached: DataFrame, permitted: DataFrame) -> DataFrame:
    """(url, source) of wanted pages: ``cache`` where there is a copy, whatever robots rules say now;
    else ``site`` where they permit it, else ``robots``."""
    copies = cached.select("url").distinct().withColumn("_copy", F.lit(True))
    may = permitted.select("url").distinct().withColumn("_may", F.lit(True))
    joined = wanted.select("url").join(copies, "url", "left").join(may, "url", "left")
    return joined.select("url", F.when(F.col("_copy"), "cache").when(F.col("_may"), "site").otherwise("robots").alias("source"))


def paced(requests: DataFrame, interval: Column, site: str = "site", asked: str = "asked", order: str = "ord") -> DataFrame:
    """Adds ``started`` and ``waited``, in seconds: a request starts ``interval`` after the one before it
    on its site, or when it is asked for, if that is later.

    The n-th start is the latest of all asked times so far, each moved on by the requests since; so a
    running maximum gives it, without a loop. ``interval`` is the larger of the run's delay and the
    site's own, and constant per site.
    """
    w = Window.partitionBy(site).orderBy(order)
    lead = F.row_number().over(w) * interval
    numbered = requests.withColumn("_lead", lead)
    started = F.max(F.col(asked) - F.col("_lead")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + F.col("_lead")
    return numbered.withColumn("started", started).withColumn("waited", F.col("started") - F.col(asked)).drop("_lead")
