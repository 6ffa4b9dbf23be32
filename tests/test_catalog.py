"""Merges left to the table format. No such format is installed here, so the calls are
recorded; that plain tables refuse row-level operations is checked for real."""

import pytest
from pyspark.sql import functions as F

from sedimenta.plans import CatalogStore
from sedimenta.sources import catalog


class Recorder:
    def __init__(self, calls):
        self.calls = calls

    def __getattr__(self, name):
        def call(*args):
            self.calls.append((name, *[str(a) for a in args]))
            return self
        return call


def test_upsert_deletes_before_it_updates(spark):
    calls = []
    catalog.merge_upsert(Recorder(calls), "lake.t", ["k"], delete_when=F.col("source.d"))
    names = [c[0] for c in calls]
    assert names == ["alias", "mergeInto", "withSchemaEvolution", "whenMatched", "delete",
                     "whenMatched", "updateAll", "whenNotMatched", "insertAll", "merge"]
    assert calls[1][1] == "lake.t" and "lake.t.k" in calls[1][2] and "source.k" in calls[1][2]


def test_set_updates_matches_only(spark):
    calls = []
    catalog.merge_set(Recorder(calls), "lake.t", [("a", "b")], {"processed": "true"})
    assert [c[0] for c in calls] == ["alias", "mergeInto", "whenMatched", "update", "merge"]


def test_plain_tables_refuse_row_level_merges(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("plain_t")
    try:
        store = CatalogStore(spark, "default", "parquet")
        assert store.name("silver", "t") == "default.silver_t"
        with pytest.raises(Exception, match="MERGE|merge"):
            catalog.merge_upsert(spark.range(1), "plain_t", ["id"])
    finally:
        spark.sql("drop table plain_t")


def test_store_creates_a_table_on_first_save(spark):
    store = CatalogStore(spark, "default", "parquet")
    try:
        assert not store.exists("silver", "made")
        assert not store.save(spark.range(3), "silver", "made", ["id"]).empty
        assert store.exists("silver", "made") and store.read("silver", "made").count() == 3
    finally:
        spark.sql("drop table if exists silver_made")
