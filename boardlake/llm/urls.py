"""URL filter: allow and block rules by a sort-merge range join (operator 10).

A rule is (host, path).  It fits its host and every subdomain, if the url's path starts
with the rule's path.  The canonical key of a rule is its host with the labels reversed,
a separator, and the path; every string that starts with the key lies in the interval
``[key, key + LAST]``.  A url has one key for each suffix of its host, so a prefix match
on host and path is membership of one of the url's keys in a rule's interval.

The intervals are laminar (two are nested or disjoint).  The sorted sweep over interval
bounds therefore only needs the top of the stack of open rules: after an opening bound it
is that rule, after a closing bound it is the rule around it.  ``rule_bounds`` computes
the stack top behind every bound; ``url_verdicts`` sorts bounds and url keys together and
carries the last bound forward.

The sort is a range partitioning on (key, salt): equal urls, however many, spread over
partitions, and the last bound of each partition is handed to the next ones.  All steps
are DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boardlake.llm.common import materialise

RULE_SCHEMA = "verdict string, host string, path string"
#: Sorts behind every character of a url: a byte that UTF-8 never uses.
LAST = b"\xff"
#: Between the host labels, and between host and path.
LABEL_END, HOST_END = "\x01", "\x02"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Empty for a null url or one without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where the host is undefined."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed_labels(labels: Column) -> Column:
    return F.array_join(F.reverse(labels), LABEL_END)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(_reversed_labels(labels), F.lit(HOST_END), path).cast("binary")


def rule_bounds(rules: DataFrame) -> DataFrame:
    """(at, opens, rule, verdict): the top of the stack of open rules behind each bound.

    ``rule`` is null where no rule is open.  A rule given twice counts once; if the two
    disagree, block wins.  Rules with a null host or path are no rules.

    The rule around a closing one is the rule of the longest proper prefix of its key that
    is itself a rule's key: host the same, path a proper prefix.
    """
    r = rules.dropna(subset=["host", "path"]).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    r = r.select("host", "path", "verdict", _key(F.split("host", "\\."), F.col("path")).alias("key"))
    # every proper prefix of the path, joined to the rules that have it
    outer = (
        r.select("host", "path", F.explode(F.sequence(F.lit(0), F.greatest(F.length("path") - 1, F.lit(0)))).alias("n"))
        .where(F.col("n") < F.length("path"))
        .select("host", "path", F.expr("substr(path, 1, n)").alias("outer_path"))
        .join(r.select("host", F.col("path").alias("outer_path"), F.col("verdict").alias("v")), ["host", "outer_path"])
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("host", F.col("outer_path").alias("path"), F.col("v").alias("verdict")), F.length("outer_path")).alias("around"))
    )
    own = F.struct("host", "path", "verdict")
    opening = r.select(F.col("key").alias("at"), F.lit(True).alias("opens"), own.alias("top"))
    closing = r.join(outer, ["host", "path"], "left").select(
        F.concat("key", F.lit(LAST)).alias("at"), F.lit(False).alias("opens"), F.col("around").alias("top")
    )
    return opening.unionByName(closing)


def url_verdicts(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict), one row per input row.

    The longest fitting rule wins (characters of host and path together; of equals the one
    with the longer host).  Without a fitting rule ``rule`` is null and the verdict is
    ``default``.  A null url, or one without ``://``, has empty host and path and fits no
    rule.  Repeated rows and repeated or null ids each keep their own row, so ids need not
    be unique.  An empty table gives an empty result; other columns are ignored.
    """
    spark = urls.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    page = urls.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    # equal (host, path) have one answer; the sweep runs on the distinct ones
    todo = page.where("host != ''").select("host", "path").distinct()
    labels = todo.withColumn("labels", F.split("host", "\\."))
    keys = labels.select("host", "path", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("k")).select(
        "host", "path", _key(F.expr("slice(labels, k, size(labels))"), F.col("path")).alias("at")
    )
    bounds = rule_bounds(rules)
    # order at one key: openings, then urls; a closing key is longer than any url key inside
    events = bounds.select("at", F.lit(0).alias("kind"), F.struct("at", "top").alias("bound"), F.lit(None).cast("string").alias("host"), F.lit(None).cast("string").alias("path")).unionByName(
        keys.select("at", F.lit(1).alias("kind"), F.lit(None).alias("bound"), "host", "path"), allowMissingColumns=True
    )
    salt = F.xxhash64("host", "path")
    swept = materialise(
        events.withColumn("salt", salt).repartitionByRange(n, "at", "kind", "salt").withColumn("part", F.spark_partition_id())
    )
    # the last bound of every partition, carried over to the partitions behind it: one row per partition
    carry = (
        swept.groupBy("part")
        .agg(F.max(F.when(F.col("kind") == 0, F.col("at"))).alias("at"), F.max_by("bound", F.when(F.col("kind") == 0, F.col("at"))).alias("last"))
        .withColumn("carried", F.last("last", ignorenulls=True).over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)))
        .select("part", "carried")
    )
    order = W.partitionBy("part").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = (
        swept.withColumn("bound", F.last("bound", ignorenulls=True).over(order))
        .where("kind = 1")
        .join(F.broadcast(carry), "part", "left")
        .select("host", "path", F.coalesce(F.col("bound.top"), F.when(F.col("bound").isNull(), F.col("carried.top"))).alias("top"))
        .where(F.col("top").isNotNull())
        .groupBy("host", "path")
        .agg(F.max(F.struct(
            (F.length("top.host") + F.length("top.path")).alias("n"), F.length("top.host").alias("hn"),
            F.concat("top.host", "top.path").alias("rule"), F.col("top.verdict").alias("verdict"))).alias("best"))
    )
    return page.join(found, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)
