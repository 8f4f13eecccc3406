"""The daily run as a graph of steps with retries, its landing sensors, metrics and alerts.

A step whose result is a table is carried out within the step (its rows are cut from their lineage), so that a job that fails
is tried again there and not somewhere behind.
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionlake.operators import conform, fuse, identity, quality
from decisionlake.plans import marts
from decisionlake.session import cut
from decisionlake.sources.tables import audited, write_partitioned


@dataclass
class Step:
    name: str
    run: Callable[[dict], object]
    after: tuple[str, ...] = ()
    retries: int = 2
    carried_out: bool = False


@dataclass
class Graph:
    """Steps in the order of their dependencies; each gets the results so far by name."""

    steps: list[Step] = field(default_factory=list)

    def order(self) -> list[Step]:
        left, done, out = {s.name: s for s in self.steps}, set(), []
        while left:
            ready = [s for s in left.values() if set(s.after) <= done]
            if not ready:
                raise ValueError(f"circular or unknown dependencies: {sorted(left)}")
            for s in ready:
                out.append(s)
                done.add(s.name)
                del left[s.name]
        return out

    def run(self, sleep: Callable[[float], None] = time.sleep) -> dict:
        results: dict = {}
        for step in self.order():
            for n in range(step.retries + 1):
                try:
                    result = step.run(results)
                    results[step.name] = cut(result) if step.carried_out and isinstance(result, DataFrame) else result
                    break
                except Exception:
                    if n == step.retries:
                        raise
                    sleep(min(2**n, 60))
        return results


def arguments(args: list[str]) -> argparse.Namespace:
    """``--env --batch_id [--run_date]`` of a job."""
    p = argparse.ArgumentParser()
    p.add_argument("--env", required=True)
    p.add_argument("--batch_id", required=True)
    p.add_argument("--run_date")
    return p.parse_args(args)


def daily_graph(raw: dict[str, DataFrame], now: Column, run_date: str | None = None) -> Graph:
    """From raw feeds (profile, bureau, fraud, aml, decisions) to the mart: conform, resolve, fuse, judge, aggregate.

    run_date: the only decision date of the run (``yyyy-MM-dd``); the filter is on the conformed decisions, before any join.
    """
    decided = lambda r: conform.decisions(raw["decisions"]).where(F.lit(True) if run_date is None else F.col("decision_date") == F.lit(run_date).cast("date"))
    return Graph([
        Step("profile", lambda r: conform.profiles(raw["profile"])[0]),
        Step("bureau", lambda r: conform.bureau_reports(raw["bureau"])),
        Step("fraud", lambda r: conform.fraud_events(raw["fraud"])),
        Step("aml", lambda r: conform.screenings(raw["aml"])),
        Step("decisions", decided),
        Step("xref", lambda r: identity.cross_reference(identity.spine(r["profile"]), r["bureau"], r["fraud"], r["aml"]), ("profile", "bureau", "fraud", "aml"), carried_out=True),
        Step("fused", lambda r: fuse.fuse(r["decisions"], r["xref"], r["bureau"], r["fraud"], r["aml"], r["profile"]), ("decisions", "xref"), carried_out=True),
        Step("judged", lambda r: quality.evaluate(r["fused"], now), ("fused",), carried_out=True),
        Step("card", lambda r: quality.scorecard(r["judged"], by=["decision_date"]).withColumnRenamed("decision_date", "snapshot_date"), ("judged",), carried_out=True),
        Step("mart", lambda r: marts.portfolio(quality.gated(r["judged"]), r["card"]), ("judged", "card")),
        Step("queue", lambda r: marts.steward_queue(r["xref"]), ("xref",)),
    ])


def landed(spark: SparkSession, paths: list[str], timeout: float = 3600.0, every: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> bool:
    """Wait until every folder holds a file; False if that hasn't come about within the time."""
    jvm, waited = spark._jvm, 0.0
    while True:
        missing = []
        for path in paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
            if not fs.exists(at) or not fs.listFiles(at, True).hasNext():
                missing.append(path)
        if not missing or waited >= timeout:
            return not missing
        sleep(every)
        waited += every


def run_day(spark: SparkSession, args: argparse.Namespace, raw: dict[str, DataFrame], out: str, now: Column) -> dict:
    """One job: the graph for the run's date, written below ``out/env`` with the batch's audit block; a repeated run replaces its day."""
    results = daily_graph(raw, now, args.run_date).run()
    for name, by in (("fused", "decision_date"), ("mart", "snapshot_date"), ("card", "snapshot_date")):
        write_partitioned(audited(results[name], "PIPELINE", args.batch_id, now if name == "fused" else F.current_timestamp()), f"{out}/{args.env}/{name}", by)
    return results


def alerts(card: DataFrame, least_score: float = 95.0) -> DataFrame:
    """``snapshot_date, alert, value``: what somebody must look at: quarantined rows, warn rules that don't hold, a low score."""
    each = F.array(
        F.when(F.col("quarantined_row_count") > 0, F.struct(F.lit("rows_quarantined").alias("alert"), F.col("quarantined_row_count").cast("double").alias("value"))),
        F.when(F.col("warn_ok_count") < F.col("warn_count"), F.struct(F.lit("warn_rules_failed").alias("alert"), (F.col("warn_count") - F.col("warn_ok_count")).cast("double").alias("value"))),
        F.when(F.col("dq_score") < least_score, F.struct(F.lit("score_low").alias("alert"), F.col("dq_score").cast("double").alias("value"))),
    )
    return card.select("snapshot_date", F.explode(F.array_compact(each)).alias("a")).select("snapshot_date", "a.*")


def metrics(card: DataFrame) -> DataFrame:
    """The scorecard's figures as ``metric, value`` rows, for whatever carries metrics."""
    names = ("total_decision_count", "passed_count", "quarantined_row_count", "dq_score")
    return card.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])).alias("m")).select("m.*")
