"""Row expectations: warn (count), drop (count and set aside) or fail (stop).

A rule that evaluates to null is violated.

`write_checked` writes a table once with all its rows: those that break a dropping rule go to the quarantine partition, every row
carries the names of the rules it breaks, and the counts are kept in a table beside it. A row that breaks a failing rule
stops the write; nothing is committed then. The counts are taken from the rows as written, by one scan of the columns that the
rules name: an `Observation` would save that scan, but once a session has held one, fitted models that refer to the
session can't be sent to tasks any more. Streams have sessions of their own; `RuleCounts` gathers what `observe` counts there.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from keepwell.session import wide_writes

QUARANTINED, BROKEN = "is_quarantined", "broken_rules"
COUNTS = "table_name string, rows_in long, rows_quarantined long, rule string, action string, violations long"
EXTENTS = "table_name string, column_name string, first_day date, last_day date"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str = "warn"

    @property
    def violated(self) -> Column:
        return ~F.coalesce(F.expr(self.condition), F.lit(False))


def warn(name: str, condition: str) -> Rule:
    return Rule(name, condition, "warn")


def drop(name: str, condition: str) -> Rule:
    return Rule(name, condition, "drop")


def fail(name: str, condition: str) -> Rule:
    return Rule(name, condition, "fail")


class ExpectationFailed(ValueError):
    pass


def drop_violations(df: DataFrame, rules) -> DataFrame:
    for rule in rules:
        if rule.action == "drop":
            df = df.where(F.expr(rule.condition))
    return df


def expect(df: DataFrame, rules, name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Attach the rules; read `observation.get` after an action has run."""
    observation = Observation(name)
    counts = [F.count_if(rule.violated).alias(rule.name) for rule in rules]
    observed = df.observe(observation, F.count(F.lit(1)).alias("rows_in"), *counts)
    return drop_violations(observed, rules), observation


def enforce(df: DataFrame, rules) -> DataFrame:
    """Stop the job at the first row that breaks a `fail` rule, naming the rule."""
    for rule in (r for r in rules if r.action == "fail"):
        broken = F.raise_error(F.lit(f"expectation failed: {rule.name}")).cast("boolean")
        df = df.where(F.when(rule.violated, broken).otherwise(F.lit(True)))
    return df


def check_failed(rules, observation: Observation) -> None:
    """After the action: raise when a `fail` rule counted violations."""
    counts = observation.get
    broken = {r.name: counts[r.name] for r in rules if r.action == "fail" and counts[r.name]}
    if broken:
        raise ExpectationFailed(f"violated: {broken}")


def violation_report(df: DataFrame, rules, table: str) -> DataFrame:
    """One row per rule with its violation count, from a single pass over the table."""
    counts = [F.count_if(rule.violated).alias(f"v{i}") for i, rule in enumerate(rules)]
    entries = F.array(*[
        F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.action).alias("action"),
                 F.col(f"v{i}").alias("violations"))
        for i, rule in enumerate(rules)])
    return (df.agg(F.count(F.lit(1)).alias("rows_in"), *counts)
            .select(F.lit(table).alias("table_name"), "rows_in", F.inline(entries)))


# ---------------------------------------------------------------- counted while written
def marked(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Adds the names of the rules a row breaks, and whether a dropping one is among them."""
    rules = list(rules)
    names = F.array_compact(F.array(*[F.when(r.violated, F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")
    aside = [r.name for r in rules if r.action == "drop"]
    return df.withColumn(BROKEN, names).withColumn(
        QUARANTINED, F.arrays_overlap(BROKEN, F.array(*map(F.lit, aside))) if aside else F.lit(False))


def counters(rules: Iterable[Rule]) -> list[Column]:
    """What is counted of marked rows; rules are told by their place, so equal names don't clash."""
    return [F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col(QUARANTINED)).alias("rows_quarantined"),
            *[F.count_if(rule.violated).alias(f"v{i}") for i, rule in enumerate(rules)]]


def count_rows(spark: SparkSession, table: str, rules: Iterable[Rule], counts: dict) -> DataFrame:
    """A row per rule."""
    rows = [(table, counts["rows_in"], counts["rows_quarantined"], r.name, r.action, counts[f"v{i}"]) for i, r in enumerate(rules)]
    return spark.createDataFrame(rows, COUNTS)


@dataclass(frozen=True)
class Checked:
    """A table written by `write_checked`."""

    rows: DataFrame  #: all rows with BROKEN and QUARANTINED
    counts: DataFrame  #: a row per rule, with the rows of the table
    extents: DataFrame  #: first and last day of each date column that was asked for

    @property
    def kept(self) -> DataFrame:
        return self.rows.where(~F.col(QUARANTINED)).drop(BROKEN, QUARANTINED)

    @property
    def quarantined(self) -> DataFrame:
        return self.rows.where(QUARANTINED).drop(QUARANTINED)


def write_checked(df: DataFrame, rules: Iterable[Rule], path: str, table: str, days: Iterable[str] = ()) -> Checked:
    """Write `df` to `path` with its rules applied, and their counts and the extents of `days` beside it.

    The counts are written last: a table without them was not finished.
    """
    rules, days, spark = list(rules), list(days), df.sparkSession
    kept = [F.when(~F.col(QUARANTINED), F.col(c).cast("date")) for c in days]
    ends = [e for i, c in enumerate(kept) for e in (F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"))]
    rows = marked(enforce(df, rules), rules)
    try:
        with wide_writes(spark):
            rows.write.mode("overwrite").partitionBy(QUARANTINED).parquet(f"{path}/rows")
    except Exception as error:
        if "expectation failed: " in str(error):
            name = str(error).split("expectation failed: ")[1].split()[0].strip("'\"[]().,;")
            raise ExpectationFailed(f"{table} not written, violated: {name}") from error
        raise
    written = spark.read.schema(rows.schema).parquet(f"{path}/rows")
    counts = written.agg(*counters(rules), *ends).first().asDict()
    extents = [(table, c, counts[f"lo{i}"], counts[f"hi{i}"]) for i, c in enumerate(days)]
    spark.createDataFrame(extents, EXTENTS).coalesce(1).write.mode("overwrite").parquet(f"{path}/extents")
    count_rows(spark, table, rules, counts).coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")
    return Checked(written, spark.read.schema(COUNTS).parquet(f"{path}/counts"),
                   spark.read.schema(EXTENTS).parquet(f"{path}/extents"))


def conservation(checked: dict[str, Checked]) -> DataFrame:
    """Per table: rows in, as counted when it was written, rows found in the two partitions now, and whether they agree."""
    parts = []
    for table, c in checked.items():
        found = c.rows.agg(F.count_if(~F.col(QUARANTINED)).alias("rows_kept"), F.count_if(QUARANTINED).alias("rows_quarantined"))
        told = c.counts.agg(F.max("rows_in").alias("rows_in"), F.max("rows_quarantined").alias("told"))
        parts.append(found.join(told).select(F.lit(table).alias("table_name"), "rows_in", "rows_kept", "rows_quarantined", (
            (F.col("rows_in") == F.col("rows_kept") + F.col("rows_quarantined")) & (F.col("told") == F.col("rows_quarantined"))).alias("balanced")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


class RuleCounts(StreamingQueryListener):
    """Counts of running streams whose rows pass `observed`, by query and batch: a batch that is told twice counts once."""

    def __init__(self):
        self._seen: dict[str, dict[int, dict]] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            with self._lock:
                self._seen.setdefault(name, {})[progress.batchId] = row.asDict()

    def settled(self, query: StreamingQuery, name: str, seconds: float = 30.0) -> None:
        """Wait until the last batch of a query that has ended was told; progress arrives a little after the batch."""
        last = query.lastProgress
        until = time.monotonic() + seconds
        while last is not None and name in last.observedMetrics and last.batchId not in self._seen.get(name, {}):
            if time.monotonic() > until:
                raise TimeoutError(f"progress of {name} did not arrive")
            time.sleep(0.05)

    def total(self, name: str) -> dict[str, int]:
        """Sums over all batches of a stream."""
        with self._lock:
            batches = list(self._seen.get(name, {}).values())
        return {key: sum(b[key] or 0 for b in batches) for key in (batches[0] if batches else ())}


def observed(df: DataFrame, rules: Iterable[Rule], name: str) -> DataFrame:
    """A stream's rows, marked and counted under `name` for `RuleCounts`."""
    rules = list(rules)
    return marked(df, rules).observe(name, *counters(rules))
