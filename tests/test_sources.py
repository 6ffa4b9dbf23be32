"""Landing files, snapshots, previews."""

import json
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from sedimenta.sources import (
    LandingFormat,
    archive_files,
    compact_table,
    create_or_upsert,
    expire_snapshots,
    latest_version,
    preview,
    read_landing,
    read_table,
    set_matched,
    table_exists,
    upsert,
    write_files,
    write_snapshot,
)
from sedimenta.sources import snapshots
from sedimenta.sources.landing import is_absent
from sedimenta.sources.snapshots import set_matched_many


def test_multiline_json_columns_come_in_alphabetical_order(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([{"z": 1, "a": True}, {"z": 2, "a": None}], indent=2))
    got = read_landing(spark, str(folder), LandingFormat(format_in="json"))
    assert got.columns == ["a", "z"] and rows(got) == [(None, 2), (True, 1)]


def test_csv_infers_types_or_takes_a_schema(spark, tmp_path):
    path = str(tmp_path / "csv")
    frame = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "i int, s string, d double")
    write_files(frame, path, format_out="csv")
    inferred = read_landing(spark, path, LandingFormat(format_in="csv"))
    assert inferred.schema == frame.schema and rows(inferred) == rows(frame)
    as_text = read_landing(spark, path, LandingFormat(format_in="csv", infer_schema="false"))
    assert {f.dataType.simpleString() for f in as_text.schema} == {"string"}
    given = read_landing(
        spark, path, LandingFormat(format_in="csv", schema="i bigint, s string, d double"))
    assert given.schema["i"].dataType.simpleString() == "bigint"


def test_parquet_rebase_modes_are_read_options(spark, tmp_path):
    path = str(tmp_path / "p")
    write_files(spark.range(3), path)
    options = {"datetimeRebaseMode": "LEGACY", "int96RebaseMode": "LEGACY"}
    assert read_landing(spark, path, LandingFormat(options=options)).count() == 3


@pytest.mark.parametrize("name", ["avro", "delta"])
def test_formats_without_a_module_say_so(spark, tmp_path, name):
    with pytest.raises(Exception, match="(?i)" + name):
        read_landing(spark, str(tmp_path), LandingFormat(format_in=name))


@pytest.mark.parametrize(
    "options", [dict(format_in="xls"), dict(header="yes"), dict(infer_schema="1"),
                dict(multiline="no")])
def test_reader_options_are_checked(options):
    with pytest.raises(ValueError):
        LandingFormat(**options)


@pytest.mark.parametrize(
    "options", [dict(format_out="xls"), dict(mode="ignore"), dict(header="yes")])
def test_writer_options_are_checked(spark, tmp_path, options):
    with pytest.raises(ValueError):
        write_files(spark.range(1), str(tmp_path / "x"), **options)


def test_write_modes_and_partitions(spark, tmp_path):
    path = str(tmp_path / "w")
    frame = spark.range(6).withColumn("p", F.col("id") % 2)
    write_files(frame, path, partition_by=["p"])
    write_files(frame, path, mode="append", partition_by=["p"])
    assert spark.read.parquet(path).count() == 12
    write_files(frame, path, partition_by=["p"])
    assert spark.read.parquet(path).count() == 6 and os.path.isdir(f"{path}/p=1")


def test_appended_columns_are_read_when_schemas_are_merged(spark, tmp_path):
    path = str(tmp_path / "e")
    write_files(spark.createDataFrame([(1, "a")], "k int, old string"), path)
    write_files(spark.createDataFrame([(2, "b")], "k int, new string"), path, mode="append")
    got = read_landing(spark, path, LandingFormat(options={"mergeSchema": "true"}))
    assert rows(got.select("k", "old", "new")) == [(1, "a", None), (2, None, "b")]


def test_absent_and_empty_folders_are_told_apart_from_errors(spark, tmp_path):
    for path in (tmp_path / "none", tmp_path):
        with pytest.raises(AnalysisException) as error:
            read_landing(spark, str(path))
        assert is_absent(error.value)


def test_archive_moves_only_what_was_read(spark, tmp_path):
    path, done = str(tmp_path / "in é 1"), str(tmp_path / "done")
    write_files(spark.range(4).repartition(2), path)
    taken = read_landing(spark, path)
    files = taken.inputFiles()
    write_files(spark.range(10, 11), path, mode="append")
    assert archive_files(spark, files, done) == 2
    assert rows(read_landing(spark, path)) == [(10,)]
    assert read_landing(spark, done).count() == 4


def test_archive_keeps_both_of_two_files_with_one_name(spark, tmp_path):
    for n in ("a", "b"):
        (tmp_path / n).mkdir()
        (tmp_path / n / "same.csv").write_text(n)
    moved = archive_files(
        spark, [str(tmp_path / n / "same.csv") for n in ("a", "b")], str(tmp_path / "done"))
    texts = {f.read_text() for f in (tmp_path / "done").iterdir() if f.suffix == ".csv"}
    assert moved == 2 and texts == {"a", "b"}


def test_readers_skip_a_version_without_success_marker(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    write_snapshot(spark.range(1), path)
    write_snapshot(spark.range(2), path)
    os.remove(f"{path}/v000002/_SUCCESS")
    assert latest_version(spark, path) == 1 and read_table(spark, path).count() == 1
    assert write_snapshot(spark.range(3), path).version == 3
    assert read_table(spark, path).count() == 3
    assert read_table(spark, path, version=1).count() == 1


def test_snapshot_reports_rows_also_of_empty_frames(spark, tmp_path):
    path = str(tmp_path / "t")
    assert write_snapshot(spark.range(7), path).rows == 7
    assert write_snapshot(spark.range(7).where("id > 10"), path).rows == 0
    assert write_snapshot(spark.range(0), path).rows == 0


def test_create_or_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "k int, v int")
    assert create_or_upsert(empty, path, "k") is None and not table_exists(spark, path)
    first = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    assert create_or_upsert(first, path, "k").rows == 2
    assert create_or_upsert(empty, path, "k") is None
    second = spark.createDataFrame([(2, 20), (3, 30)], "k int, v int")
    assert create_or_upsert(second, path, "k").rows == 3
    assert rows(read_table(spark, path)) == [(1, 1), (2, 20), (3, 30)]
    assert [n for n in os.listdir(f"{path}/_staging") if not n.startswith(".")] == []


def test_staging_is_cleared_when_a_merge_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    twice = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    write_snapshot(spark.createDataFrame([(1, 0)], "k int, v int"), path)
    with pytest.raises(Exception, match="several source rows"):
        create_or_upsert(twice, path, "k")
    assert rows(read_table(spark, path)) == [(1, 0)]
    assert [n for n in os.listdir(f"{path}/_staging") if not n.startswith(".")] == []


def test_large_sources_are_merged_in_one_join_with_the_same_result(spark, tmp_path):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    first = spark.createDataFrame([(1, 1), (None, 2), (3, 3)], "k int, v int")
    second = spark.createDataFrame([(3, 30), (None, 20), (4, 40)], "k int, v int")
    stored = []
    try:
        for limit in (before, "-1"):
            spark.conf.set(name, limit)
            path = str(tmp_path / limit)
            create_or_upsert(first, path, "k", source_unique=True)
            assert create_or_upsert(second, path, "k", source_unique=True).rows == 5
            stored.append(rows(read_table(spark, path)))
    finally:
        spark.conf.set(name, before)
    assert stored[0] == stored[1]


def test_stored_upsert_with_delete_and_set(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(spark.createDataFrame([(1, 1, False), (2, 2, False)], "k int, v int, p boolean"), path)
    source = spark.createDataFrame([(1, 9), (2, 3)], "k int, v int")
    upsert(source, path, "k", delete_when="source.v > 5")
    assert rows(read_table(spark, path)) == [(2, 3, False)]
    set_matched(source.select("k"), path, "k", {"p": "true"})
    assert rows(read_table(spark, path)) == [(2, 3, True)]
    repeated = source.select(F.col("k").alias("x")).union(source.select("k"))
    set_matched_many(repeated, {path: [("k", "x")]}, {"p": "false"})
    assert rows(read_table(spark, path)) == [(2, 3, False)]


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(spark.range(1000).repartition(20), path)
    assert compact_table(spark, path).rows == 1000
    files = [f for f in os.listdir(f"{path}/v000002") if f.endswith(".parquet")]
    assert len(files) == 1 and read_table(spark, path).count() == 1000
    with pytest.raises(FileNotFoundError):
        compact_table(spark, str(tmp_path / "none"))


def test_expire_keeps_the_newest_complete_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 6):
        write_snapshot(spark.range(n), path)
    os.remove(f"{path}/v000002/_SUCCESS")
    assert expire_snapshots(spark, path, keep=2) == [1, 2, 3]
    assert read_table(spark, path).count() == 5 and read_table(spark, path, 4).count() == 4
    assert expire_snapshots(spark, path, keep=2) == []
    with pytest.raises(ValueError):
        expire_snapshots(spark, path, keep=0)


def test_preview(spark):
    frame = spark.createDataFrame([(1, None), (2, True)], "i int, b boolean")
    assert rows(preview(frame, None)) == [("1", None), ("2", "true")]
    assert preview(spark.range(100)).count() == 5


def test_a_new_table_is_refused_repeated_keys(spark, tmp_path):
    repeated = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="share one key"):
        create_or_upsert(repeated, str(tmp_path / "t"), "k")
    keyless = spark.createDataFrame([(None, "a"), (None, "b")], "k int, v string")
    assert create_or_upsert(keyless, str(tmp_path / "u"), "k").rows == 2


def test_setting_all_rows_writes_no_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    write_snapshot(spark.createDataFrame([(1, False), (2, None)], "k int, p boolean"), path)
    assert snapshots.set_all(spark, path, {"p": "true"}).rows == 2
    assert [f for f in os.listdir(f"{path}/v000002") if f.endswith(".parquet")] == []
    assert rows(read_table(spark, path)) == [(1, True), (2, True)]
    assert rows(read_table(spark, path, 1)) == [(1, False), (2, None)]
    assert snapshots.set_all(spark, path, {"k": "7"}).version == 3
    # What the notes stand on stays as long as one of them does.
    assert expire_snapshots(spark, path, keep=1) == [1, 2]
    assert rows(read_table(spark, path)) == [(7, True), (7, True)]
    assert sorted(d for d in os.listdir(path) if d.startswith("v")) == ["v000003"]
    snapshots.set_all(spark, path, {"k": "k + 1"})  # not a constant: the rows are written
    assert expire_snapshots(spark, path, keep=1) == [3]
    assert rows(read_table(spark, path)) == [(8, True), (8, True)] and os.listdir(f"{path}/_base") == []


def test_a_write_leaves_no_shuffle_files_and_no_setting(spark, tmp_path):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    with snapshots.shuffles_dropped(spark), snapshots.shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name, None) == before
    info = write_snapshot(spark.range(100).repartition(3, "id"), str(tmp_path / "t"))
    assert info.rows == 100 and any(f.endswith(".zstd.parquet") for f in os.listdir(info.path))
