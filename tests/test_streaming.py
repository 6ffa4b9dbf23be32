"""Landing folders as streams."""

import os

import pytest

from conftest import rows
from sedimenta.plans import retail
from sedimenta.sources import LandingFormat, write_files
from sedimenta.streaming import ingest_landing_stream

SCHEMA = "n_id_fil bigint, n_id_vd_fil bigint, n_id_pdd bigint"


def pairs(spark, *numbers):
    return spark.createDataFrame([(1, n, n) for n in numbers], SCHEMA).coalesce(1)


@pytest.fixture
def table():
    specs = retail.table_specs(landing={"pedido_venda": LandingFormat(schema=SCHEMA)})
    return next(s for s in specs if s.name == "pedido_venda")


def test_each_file_is_taken_once_over_restarts(spark, store, layout, table, tmp_path):
    landing = layout.path("transient", "pedido_venda")
    checkpoint = str(tmp_path / "checkpoint")

    def take(**options):
        return ingest_landing_stream(spark, store, table, layout, checkpoint, **options)

    for n in (1, 2, 3):
        write_files(pairs(spark, n, n + 10), landing, mode="append")
    take(max_files_per_trigger=1, as_of="2026-12-01 00:00:00")
    assert store.read("bronze", "pedido_venda").count() == 6
    archived = [f for _, _, names in os.walk(layout.transient + "/TRANSIENTFILES") for f in names
                if f.endswith(".parquet")]
    assert len(archived) == 2

    write_files(pairs(spark, 1, 4), landing, mode="append")
    take(as_of="2026-12-02 00:00:00")
    take(as_of="2026-12-03 00:00:00")
    got = store.read("bronze", "pedido_venda").selectExpr("n_id_pdd", "day(creationDate)")
    assert dict(rows(got)) == {1: 2, 2: 1, 3: 1, 4: 2, 11: 1, 12: 1, 13: 1}


def test_stream_needs_a_schema(spark, store, layout, tmp_path):
    with pytest.raises(ValueError):
        ingest_landing_stream(
            spark, store, retail.table_specs()[0], layout, str(tmp_path / "c"))
