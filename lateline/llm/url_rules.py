"""URL filters: a sort-merge range join of pages with nested host and path rules.

A host is written backwards, label by label, each closed by a slash: ``www.example.com`` is ``com/example/www/``. The
hosts that a rule fits are then exactly the keys in the interval from its own key up to, not including, the key with
the last slash made ``0`` (the next character). Rules of the same path have nested or disjoint intervals, so one sorted
sweep over interval ends and hosts needs no more than a stack: a start pushes its rule, an end pops it, and the top of
the stack is the longest rule that fits the hosts that follow.

The sweep runs distributed: a start sets the state to its own rule, an end to the rule below it on the stack (found
beforehand by joining each rule's shorter host prefixes with the rules). Keys are range-partitioned and each partition
is swept with the last state of the partitions before it. Pages are first counted down to distinct places (host and
the part of the path that rules look at), so a host with a third of all pages is a few rows in the sweep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host between the first ``://`` and ``/``, ``?``, ``#`` or the end, and the path up to ``?``, ``#`` or the end.

    Only A-Z are lower-cased. Null, or without ``://``: both empty.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def backwards(host: Column) -> Column:
    """``www.example.com`` as ``com/example/www/``; a host can't hold a slash, so labels can't run together."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "/"), F.lit("/"))


def _shorter(key: Column) -> Column:
    """The key's own prefixes of fewer labels: ``com/example/`` has ``com/``."""
    labels = F.split(F.rtrim(key, F.lit("/")), "/", -1)
    return F.transform(
        F.filter(F.sequence(F.lit(0), F.size(labels) - 1), lambda n: n > 0),
        lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "/"), F.lit("/")),
    )


def _events(rules: DataFrame) -> DataFrame:
    """Starts and ends of all rules, each with the rule on top of the stack after it ('' when the stack is empty)."""
    shorter = rules.select("rule_path", "key", "rule", F.explode(_shorter(F.col("key"))).alias("below_key"))
    below = rules.select("rule_path", F.col("key").alias("below_key"), F.col("rule").alias("below"))
    parents = (
        shorter.join(below, ["rule_path", "below_key"])
        .groupBy("rule_path", "key")
        .agg(F.max_by("below", F.length("below_key")).alias("below"))
    )
    ends = F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("0"))
    return (
        rules.join(parents, ["rule_path", "key"], "left")
        .select(
            "rule_path",
            F.explode(
                F.array(
                    F.struct("key", F.col("rule").alias("state")),
                    F.struct(ends.alias("key"), F.coalesce("below", F.lit("")).alias("state")),
                )
            ).alias("event"),
        )
        .select("rule_path", "event.key", F.lit(0).alias("is_probe"), "event.state")
    )


def _sweep(events: DataFrame, probes: DataFrame, scratch: Scratch) -> DataFrame:
    """The rule on top of the stack at each probe's key; probes that no rule fits are left out."""
    points = events.unionByName(probes.withColumn("is_probe", F.lit(1)).withColumn("state", F.lit(None).cast("string")))
    order = ["rule_path", "key", "is_probe"]
    # The partition numbers are data from here on, so they are stored before anything depends on them.
    parts = scratch.keep(points.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "points")
    last = (
        parts.where("is_probe = 0").groupBy("part").agg(F.max_by("state", F.struct("rule_path", "key")).alias("last"))
    )
    # One row for each partition of the sweep: the state it begins with.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        parts.select("part").distinct().join(last, "part", "left")
        .select("part", F.last("last", ignorenulls=True).over(before).alias("carried"))
    )
    within = Window.partitionBy("part").orderBy(*order)
    return (
        parts.join(carried, "part")
        .withColumn("state", F.coalesce(F.last("state", ignorenulls=True).over(within), "carried"))
        .where("is_probe = 1 AND state <> ''")
        .select("rule_path", "key", F.col("state").alias("rule"))
    )


def judge_urls(
    pages: DataFrame, rules: DataFrame, *, page_id: str = "page_id", url: str = "url", default: str = ALLOW
) -> DataFrame:
    """One row for each page: page_id, host, path, rule (null where none fits), verdict.

    ``rules`` has ``host``, ``path`` and ``verdict``. A rule fits its host and all subdomains where the url's path
    begins with the rule's; the longest rule wins, by host and path together. Of rules with the same host and path and
    different verdicts the blocking one holds. Pages without a rule get ``default``.

    A null url, or one without ``://``, has an empty host and path and fits no rule. Null and repeated ids and repeated
    rows stay as they are, one row each; other columns, whatever their names, are not read. No pages: no rows. No
    rules: every page gets ``default``. A rule with a null host, path or verdict is left out.
    """
    spark = pages.sparkSession
    scratch = Scratch(spark, "url_rules")
    rules = (
        rules.select(F.translate("host", UPPER, LOWER).alias("host"), F.col("path").alias("rule_path"), "verdict")
        .dropna()
        .groupBy("host", "rule_path")
        .agg(F.max("verdict").alias("rule_verdict"))
        .select("rule_path", backwards(F.col("host")).alias("key"), F.concat("host", "rule_path").alias("rule"), "rule_verdict")
    )
    lengths = sorted(row[0] for row in rules.select(F.length("rule_path")).distinct().collect())
    host, path = host_and_path(F.col(url))
    parsed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    parsed = parsed.withColumn("head", F.substring("path", 1, lengths[-1] if lengths else 0))
    places = parsed.select("host", "head").distinct()
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("head"))
    probes = places.select("host", "head", F.explode(fitting).alias("n")).select(
        "host", "head", F.expr("substring(head, 1, n)").alias("rule_path"), backwards(F.col("host")).alias("key")
    )
    found = _sweep(_events(rules), probes.select("rule_path", "key").distinct(), scratch)
    best = (
        probes.join(found, ["rule_path", "key"])
        .join(rules.select("rule_path", "rule", "rule_verdict"), ["rule_path", "rule"])
        .groupBy("host", "head")
        .agg(F.max_by(F.struct("rule", "rule_verdict"), F.struct(F.length("rule"), F.length("rule_path"))).alias("best"))
    )
    return parsed.join(best, ["host", "head"], "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
