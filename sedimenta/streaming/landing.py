"""Bronze ingest as a file stream run to exhaustion.

The checkpoint remembers which files were taken, so each file is read once however often
the job is started, and Spark itself archives files that are done. A batch that is repeated after a
failure is known by the number of its query and its own, and is not saved again: its rows keep
their ``creationDate`` and their ``processed`` flag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sedimenta.operators.quarantine import split_rejected
from sedimenta.plans.spec import LakeLayout, TableSpec
from sedimenta.plans.steps import AsOf, Store, apply_step, save_rejected


def ingest_landing_stream(
    spark: SparkSession,
    store: Store,
    spec: TableSpec,
    layout: LakeLayout,
    checkpoint: str,
    *,
    archive: bool = True,
    max_files_per_trigger: int | None = None,
    as_of: AsOf = None,
) -> StreamingQuery:
    """Take every landing file not taken before into the bronze table, then stop.

    ``spec.landing.schema`` must be given: a stream does not infer. By default all new
    files form one batch; ``max_files_per_trigger`` bounds a batch at the price of one
    merge per batch. Archiving runs behind by one batch, so the last file taken may stay
    in the landing folder; it is not read again.
    """
    landing = spec.landing
    if landing.schema is None:
        raise ValueError(f"{spec.name}: a landing stream needs a schema")
    reader = (
        spark.readStream.format(landing.format_in)
        .schema(landing.reader_schema())
        .options(**landing.reader_options())
    )
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive:
        reader = reader.option("cleanSource", "archive").option(
            "sourceArchiveDir", layout.archive(spec.name)
        )

    def take(batch: DataFrame, batch_id: int) -> None:
        save_batch(store, spec, batch, checkpoint, batch_id, as_of)

    query = (
        reader.load(layout.path("transient", spec.name))
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def save_batch(
    store: Store, spec: TableSpec, batch: DataFrame, query: str, batch_id: int, as_of: AsOf = None
) -> bool:
    """One batch of a stream into bronze; False if it was there already. ``query`` names the stream,
    as its checkpoint folder does for good."""
    if store.keeps_versions and store.has_batch("bronze", spec.name, query, batch_id):
        return False
    if spec.quarantines:
        batch, bad = split_rejected(batch, spec.checks, spec.landing.corrupt)
        save_rejected(store, spec, bad, as_of)
    frame = apply_step(batch, spec.bronze, as_of)
    named = {"batch": (query, batch_id)} if store.keeps_versions else {}
    store.save(
        frame, "bronze", spec.name, list(spec.bronze.upsert_key), unique=spec.bronze.makes_keys_distinct, **named
    )
    return True
