"""A whole run over many tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import astuple

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from sedimenta.plans.spec import GoldSpec, LakeLayout, StepResult, TableSpec
from sedimenta.plans.steps import AsOf, Store, run_bronze, run_gold, run_silver

REPORT_SCHEMA = "table string, layer string, status string, rows bigint, reason string"


def run_lake(
    store: Store,
    layout: LakeLayout,
    tables: Sequence[TableSpec],
    golds: Sequence[GoldSpec],
    *,
    as_of: AsOf = None,
    incremental: bool = False,
    archive: bool = False,
    threads: int = 1,
) -> list[StepResult]:
    """Bronze and silver of each table, and each gold table once the tables it reads are done.

    Source tables do not depend on one another, so ``threads`` steps may be submitted at a time,
    which fills the cluster while small tables run; under a FAIR scheduler each has a pool of its
    own. A gold table waits for its own inputs only, not for other tables, and may read other gold
    tables (``GoldSpec.after``). One over a table that failed in this run is skipped, and so are
    those after it. The report is in the order given, tables first, whatever ended first.
    """
    _refuse_circles(golds)

    def load(spec: TableSpec) -> list[StepResult]:
        store.spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        return [
            run_bronze(store, spec, layout, as_of, archive),
            run_silver(store, spec, as_of, incremental),
        ]

    def build(spec: GoldSpec) -> list[StepResult]:
        store.spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
        return [run_gold(store, spec, incremental)]

    names = {t.name for t in tables}
    waiting = {("gold", g.name): g for g in golds}
    needs = {k: {("silver", t) for t in g.tables if t in names} | {("gold", a) for a in g.after if ("gold", a) in waiting} for k, g in waiting.items()}
    done: dict[tuple[str, str], list[StepResult]] = {}
    failed: set[tuple[str, str]] = set()
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        submit = lambda step, spec: pool.submit(inheritable_thread_target(store.spark)(step), spec)
        running = {submit(load, t): ("silver", t.name) for t in tables}
        while running or waiting:
            for key in [k for k in waiting if needs[k] <= done.keys()]:
                spec, stale = waiting.pop(key), sorted(name for _, name in needs[key] & failed)
                if stale:
                    done[key] = [StepResult(spec.name, "gold", "skipped", reason=f"a step failed: {stale}")]
                    failed.add(key)
                    break  # others may have waited for this one
                running[submit(build, spec)] = key
            else:
                for ended in wait(running, return_when=FIRST_COMPLETED).done:
                    key = running.pop(ended)
                    done[key] = ended.result()
                    if any(r.status == "failed" for r in done[key]):
                        failed.add(key)
    order = [("silver", t.name) for t in tables] + [("gold", g.name) for g in golds]
    return [result for key in order for result in done[key]]


def _refuse_circles(golds: Sequence[GoldSpec]) -> None:
    after = {g.name: set(g.after) & {x.name for x in golds} for g in golds}
    while after:
        ready = {n for n, needed in after.items() if not needed & after.keys()}
        if not ready:
            raise ValueError(f"gold tables wait for one another: {sorted(after)}")
        after = {n: needed for n, needed in after.items() if n not in ready}


def report_frame(
    spark: SparkSession, results: Sequence[StepResult], rejected: bool = False
) -> DataFrame:
    """The outcome of a run as a frame: one row per step; with ``rejected`` also the numbers of
    records that were set aside."""
    schema = f"{REPORT_SCHEMA}, rejected bigint" if rejected else REPORT_SCHEMA
    width = len(schema.split(","))
    return spark.createDataFrame([astuple(r)[:width] for r in results], schema)
