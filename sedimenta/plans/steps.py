"""The layer steps: landing -> bronze -> silver -> gold.

Each step is one lazy frame and one write of it. A step never raises for bad data or a
missing input: it reports, so that one table cannot stop the others.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Mapping
from contextlib import ExitStack
from functools import partial, wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sedimenta.operators.audit import CREATED, PROCESSED, normalize_temporal, only_unprocessed, with_audit
from sedimenta.operators.changes import rows_after, rows_gone
from sedimenta.operators.dedupe import dedupe
from sedimenta.operators.quarantine import RECORD_KEY, split_rejected
from sedimenta.plans.partitioned import PartitionedStore
from sedimenta.plans.spec import GoldSpec, LakeLayout, StepResult, StepSpec, TableSpec
from sedimenta.plans.sql import run_sql
from sedimenta.plans.stores import CatalogStore, Saved, SnapshotStore
from sedimenta.sources.landing import archive_files, is_absent, read_landing

Store = SnapshotStore | PartitionedStore | CatalogStore
AsOf = str | dt.datetime | None

log = logging.getLogger(__name__)


def apply_step(df: DataFrame, step: StepSpec, as_of: AsOf = None) -> DataFrame:
    """Transform, type clean-up, audit columns, one row per key.

    With ``merge_key`` the newest version of a record stays, by the ``creationDate`` of the
    layer below, where the transform passes it on; ``order_by`` decides among equals.
    """
    if step.merge_key is not None:
        versions, order = _versions(df, step)
        return with_audit(dedupe(versions, step.merge_key, order), as_of)
    shaped = shape_step(df, step, as_of)
    return shaped if step.distinct else dedupe(shaped, step.key, step.order_by, pack=True)


def shape_step(df: DataFrame, step: StepSpec, as_of: AsOf = None) -> DataFrame:
    """``apply_step`` before the dedupe."""
    return with_audit(normalize_temporal(_transformed(df, step)), as_of)


def _versions(df: DataFrame, step: StepSpec) -> tuple[DataFrame, list[str | Column]]:
    """The versions of the records of a step with ``merge_key``, and the order that decides among them."""
    versions = normalize_temporal(_transformed(df, step))
    newest = [F.col(CREATED).desc_nulls_last()] if CREATED in versions.columns else []
    return versions, [*newest, *step.order_by]


def _save_step(
    store: Store, df: DataFrame, step: StepSpec, layer: str, table: str, as_of: AsOf, **more: object
) -> Saved:
    """Save ``apply_step`` of a frame."""
    on = list(step.upsert_key)
    if not store.keeps_versions or (step.distinct and step.merge_key is None):
        return store.save(apply_step(df, step, as_of), layer, table, on, unique=step.makes_keys_distinct, **more)
    if step.merge_key is None:
        return store.save_first(shape_step(df, step, as_of), layer, table, on, step.key, step.order_by, **more)
    versions, order = _versions(df, step)
    audited = partial(with_audit, as_of=as_of)
    return store.save_first(versions, layer, table, on, step.merge_key, order, audited, **more)


def _transformed(df: DataFrame, step: StepSpec) -> DataFrame:
    if callable(step.transform):
        return step.transform(df)
    if step.view is None:
        raise ValueError("a step given as SQL text needs the name of its view")
    return run_sql(df.sparkSession, step.transform, {step.view: df}, step.args)


def _reported(layer: str) -> Callable:
    def decorate(step: Callable[..., StepResult]) -> Callable[..., StepResult]:
        @wraps(step)
        def run(store: Store, spec: TableSpec | GoldSpec, *args, **kwargs) -> StepResult:
            try:
                result = step(store, spec, *args, **kwargs)
            except Exception as error:  # the report carries it; other tables go on
                log.exception("%s %s failed", layer, spec.name)
                result = StepResult(spec.name, layer, "failed", reason=_first_line(error))
            log.info("%s %s: %s %s", layer, spec.name, result.status, result.reason)
            return result

        return run

    return decorate


def _first_line(error: Exception) -> str:
    return (str(error).strip() or type(error).__name__).splitlines()[0]


@_reported("bronze")
def run_bronze(
    store: Store, spec: TableSpec, layout: LakeLayout, as_of: AsOf = None, archive: bool = False
) -> StepResult:
    """Landing files -> bronze table. With ``archive`` the files read are moved away once
    the table is written."""
    try:
        landing = read_landing(store.spark, layout.path("transient", spec.name), spec.landing)
    except AnalysisException as error:
        if not is_absent(error):
            raise
        return StepResult(spec.name, "bronze", "skipped", reason="no landing files")
    taken = landing.inputFiles() if archive else []
    rejected = 0
    if spec.quarantines:
        landing, bad = split_rejected(landing, spec.checks, spec.landing.corrupt)
        rejected = save_rejected(store, spec, bad, as_of)
    saved = _save_step(store, landing, spec.bronze, "bronze", spec.name, as_of)
    if saved.empty and not rejected:
        return StepResult(spec.name, "bronze", "skipped", reason="no landing rows")
    archive_files(store.spark, taken, layout.archive(spec.name))
    if saved.empty:
        return StepResult(spec.name, "bronze", "skipped", reason="no good landing rows", rejected=rejected)
    return StepResult(spec.name, "bronze", "ok", saved.rows, rejected=rejected)


def save_rejected(store: Store, spec: TableSpec, bad: DataFrame, as_of: AsOf = None) -> int:
    """Rejected records into the table beside bronze, each once; how many the batch had."""
    seen = Observation()
    counted = with_audit(bad, as_of).observe(seen, F.count(F.lit(1)).alias("rows"))
    store.save(counted, "bronze", f"{spec.name}_rejected", [RECORD_KEY], unique=True)
    return seen.get["rows"]


@_reported("silver")
def run_silver(
    store: Store, spec: TableSpec, as_of: AsOf = None, incremental: bool = False
) -> StepResult:
    """Bronze table -> silver table, then mark the bronze rows as processed.

    All of bronze is taken each time unless ``incremental``, which takes the rows not yet
    marked, or those changed since the last run (``TableSpec.tracks``); silver ends up the same
    but for the ``creationDate`` of rows already there.
    """
    if not store.exists("bronze", spec.name):
        return StepResult(spec.name, "silver", "skipped", reason="no bronze table")
    if incremental and spec.tracks == "changes" and store.keeps_versions:
        return _silver_from_changes(store, spec, as_of)
    version = store.version("bronze", spec.name)
    bronze = store.read("bronze", spec.name)
    batch = only_unprocessed(bronze) if incremental else bronze
    step = spec.silver
    if step.keeps_keys and batch.isEmpty():
        return StepResult(spec.name, "silver", "skipped", reason="no bronze rows")
    plain_scan = {"stage": False} if step.keeps_keys and not incremental else {}
    saved = _save_step(store, batch, step, "silver", spec.name, as_of, **plain_scan)
    if saved.empty:
        return StepResult(spec.name, "silver", "skipped", reason="no bronze rows")
    if not spec.set_on_bronze:
        return StepResult(spec.name, "silver", "ok", saved.rows)
    known = version is not None and store.version("bronze", spec.name) == version
    if known and (step.keeps_keys or (step.one_to_one and step.merge_key is not None)):
        # Every row of bronze or of its unmarked part was taken, so no join tells which. If the mark
        # is all that is set, rows that have it already have the same value in them.
        marks_only = {c: v.strip().lower() for c, v in spec.set_on_bronze.items() if isinstance(v, str)} == {PROCESSED: "true"}
        if store.keeps_versions and (marks_only or not incremental):
            store.set_all("bronze", spec.name, spec.set_on_bronze)
        else:
            taken = ~F.coalesce(F.col(PROCESSED), F.lit(False)) if incremental else F.lit(True)
            store.set_where("bronze", spec.name, taken, spec.set_on_bronze)
    elif step.keeps_keys:
        # Rows may have landed since: those of the batch only, each as it was when read.
        store.set_matched(batch, "bronze", spec.name, [*step.key, CREATED], spec.set_on_bronze)
    else:
        keys = shape_step(batch, step, as_of)
        # Of all rows of bronze most have come out: those that have not are looked for instead.
        mark = store.set_most if known and not incremental and store.keeps_versions else store.set_matched
        mark(keys, "bronze", spec.name, list(step.key), spec.set_on_bronze)
    return StepResult(spec.name, "silver", "ok", saved.rows)


def _silver_from_changes(store: SnapshotStore, spec: TableSpec, as_of: AsOf) -> StepResult:
    """Silver from what changed in bronze since the version it was last made from.

    A row that left bronze leaves silver where the step keeps keys; a step that folds rows
    cannot tell, and keeps what it has.
    """
    step, version = spec.silver, store.version("bronze", spec.name)
    since = store.taken("silver", spec.name).get("bronze")
    if since == version:
        return StepResult(spec.name, "silver", "skipped", reason="no changes in bronze")
    fresh = since is None or not store.exists("silver", spec.name)
    changes = None if fresh else store.change_slices("bronze", spec.name, since, spec.bronze.upsert_key)
    if changes is None:
        saved = _save_step(store, store.read("bronze", spec.name), step, "silver", spec.name, as_of)
    else:
        with store.held(changes, "silver", spec.name) as (changed, rows):
            if not rows:
                store.note_taken("silver", spec.name, {"bronze": version})
                return StepResult(spec.name, "silver", "skipped", reason="no changes in bronze")
            gone = rows_gone(changed) if step.keeps_keys else None
            gone = None if gone is None or gone.isEmpty() else gone
            saved = _save_step(store, rows_after(changed), step, "silver", spec.name, as_of, gone=gone)
    store.note_taken("silver", spec.name, {"bronze": version})
    if saved.empty:
        return StepResult(spec.name, "silver", "skipped", reason="no bronze rows")
    return StepResult(spec.name, "silver", "ok", saved.rows)


@_reported("gold")
def run_gold(store: Store, spec: GoldSpec, incremental: bool = False) -> StepResult:
    """Silver tables -> joined gold table, then the write-back to silver if there is one.

    With ``incremental`` the rows whose inputs changed since the last run are rebuilt, and rows
    that no longer come out leave the table; the result is that of building all of it. That is
    done too where the spec or the store cannot follow changes, or a version is gone.
    """
    missing = [t for t in spec.tables if not store.exists("silver", t)]
    if missing:
        return StepResult(spec.name, "gold", "skipped", reason=f"no silver table: {missing}")
    if incremental and store.keeps_versions:
        saved = _gold_from_changes(store, spec)
        if saved is None:
            return StepResult(spec.name, "gold", "skipped", reason="no changes in silver")
    else:
        silver = {t: store.read("silver", t) for t in spec.tables}
        frame = _built(store, spec, silver)
        saved = store.save(frame, "gold", spec.name, list(spec.key), unique=not spec.distinct)
    if saved.empty:
        return StepResult(spec.name, "gold", "skipped", reason="the join gave no rows")
    if spec.write_back:
        gold = store.read("gold", spec.name)
        for table, on in spec.write_back.items():
            store.set_matched(gold, "silver", table, on, spec.set_on_silver)
    return StepResult(spec.name, "gold", "ok", saved.rows)


def _built(store: Store, spec: GoldSpec, silver: Mapping[str, DataFrame]) -> DataFrame:
    frame = spec.build(silver) if callable(spec.build) else run_sql(store.spark, spec.build, silver)
    return frame if spec.distinct else dedupe(frame, spec.key, spec.order_by)


def _gold_from_changes(store: SnapshotStore, spec: GoldSpec) -> Saved | None:
    """Gold brought up to date with its inputs; None if none of them changed."""
    versions = {t: store.version("silver", t) for t in spec.tables}
    silver = {t: store.read("silver", t) for t in spec.tables}
    taken = store.taken("gold", spec.name)
    now = {**versions, "stamp": spec.stamp}
    saved = None
    if store.exists("gold", spec.name) and taken == now:
        return None
    changes = _silver_changes(store, spec, taken) if spec.propagates else None
    if changes is None:
        saved = store.overwrite(_built(store, spec, silver), "gold", spec.name)
    else:
        with ExitStack() as stack:
            # One input after another, so that the shuffles of one are gone before the next are made.
            # The changes themselves go as soon as it is known what they touch.
            hold = lambda on, frame: on.enter_context(store.held(frame, "gold", spec.name))
            with ExitStack() as inputs:
                changed = {t: hold(inputs, c)[0] for t, c in changes.items()}
                touched, rows = hold(stack, spec.touched(changed, silver).select(*spec.key).distinct())
            if rows:
                fresh = _built(store, spec, spec.narrow(silver, touched))
                saved = store.replace(fresh, "gold", spec.name, touched, list(spec.key))
    store.note_taken("gold", spec.name, now)
    return saved


def _silver_changes(
    store: SnapshotStore, spec: GoldSpec, taken: Mapping[str, object]
) -> dict[str, list[DataFrame]] | None:
    """What changed in each input since the last run; None if that cannot be told."""
    if not store.exists("gold", spec.name) or taken.get("stamp") != spec.stamp:
        return None
    changes = {}
    for table in spec.tables:
        since = taken.get(table)
        changed = None if since is None else store.change_slices("silver", table, since, spec.input_keys[table])
        if changed is None:
            return None
        changes[table] = changed
    return changes
