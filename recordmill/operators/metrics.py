"""Statistics of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Values of a group are cut into so many ranges at most by their approximate quantiles.
RANGES = 64


def percentile_by_group(df: DataFrame, group: list[str], value: str, p: float, name: str) -> DataFrame:
    """The value at floor((n - 1) p) in order of each group: an exact value of the data.

    Counts per distinct value come first. Their running sum is taken within ranges of a group, cut at
    approximate quantiles, and only the range that holds the wanted rank is looked through, so no
    task orders a whole group. A group has at most RANGES ranges."""
    rows = df.where(F.col(value).isNotNull()).select(*group, F.lit(0).alias("__g"), F.col(value).alias("__v"))
    key = [*group, "__g"]
    counts = rows.groupBy(*key, "__v").agg(F.count("*").alias("__n"))
    cuts = rows.groupBy(*key).agg(F.array_distinct(F.percentile_approx("__v", [k / RANGES for k in range(1, RANGES)], 1000)).alias("__cuts"))
    ranged = counts.join(cuts, key).withColumn("__r", F.size(F.filter("__cuts", lambda x: x < F.col("__v")))).drop("__cuts")
    in_order = Window.partitionBy(*key).orderBy("__r")
    totals = ranged.groupBy(*key, "__r").agg(F.sum("__n").alias("__in"))
    totals = totals.withColumn("__before", F.sum("__in").over(in_order) - F.col("__in")).withColumn("__rank", F.floor((F.sum("__in").over(Window.partitionBy(*key)) - 1) * F.lit(p)))
    totals = totals.where("__before <= __rank and __rank < __before + __in").drop("__in")
    running = Window.partitionBy(*key).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    here = ranged.join(totals, [*key, "__r"]).withColumn("__upto", F.col("__before") + F.sum("__n").over(running))
    return here.where("__upto > __rank").groupBy(*key).agg(F.min("__v").alias(name)).drop("__g")


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def best(df: DataFrame, eligible: Column, *order: str) -> DataFrame:
    return df.where(eligible).orderBy(*order).limit(1)


def alarms(events: DataFrame, at: str, breach: Column, threshold: int, width: str = "60 seconds", periods: int = 2) -> DataFrame:
    """Windows in which more than ``threshold`` events breach, as they do in the ``periods - 1`` before."""
    counts = events.where(breach).groupBy(F.window(at, width).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n").where(F.col("n") > threshold)
    # a window is found again under the starts of those that follow it: an equality join, no global order
    before = counts
    for k in range(1, periods):
        earlier = counts.select((F.col("window_start") + F.expr(f"INTERVAL {width}") * k).alias("window_start"))
        before = before.join(earlier, "window_start", "left_semi")
    return before.select("window_start", "n")


def run_totals(scenarios: DataFrame, letters: DataFrame) -> DataFrame:
    """One row for a run: its scenarios and their records, and what lies in each dead-letter queue.

    scenarios: name, records; letters: queue (intake, chunk or completion), a row for each message."""
    totals = scenarios.agg(F.countDistinct("name").alias("scenario_count"), F.coalesce(F.sum("records"), F.lit(0)).cast("long").alias("total_records"))
    of = lambda q: F.count_if(F.col("queue") == q).alias(f"{q}_dlq_count")
    return totals.join(F.broadcast(letters.agg(of("intake"), of("chunk"), of("completion"))))  # one row each


def report_matrix(reports: DataFrame) -> DataFrame:
    """The cases of all reports, each once, in order of memory and stage, with the memory sizes that
    occur, sorted. reports: memory, stage and more."""
    cases = reports.distinct()
    sizes = cases.agg(F.array_sort(F.collect_set("memory")).alias("memory_sizes"))  # as many as there are sizes
    return cases.join(F.broadcast(sizes)).orderBy("memory", "stage")
