"""merge_frames against hand-made cases and against a model in plain Python."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from sedimenta.operators import merge_frames


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


FORMS = [dict(), dict(source_unique=True), dict(source_unique=True, form="outer"), dict(form="outer")]
every_form = pytest.mark.parametrize("form", FORMS, ids=["checked", "unique", "outer", "outer-checked"])


@every_form
def test_upsert_keeps_columns_the_source_lacks_and_adds_new_ones(spark, form):
    target = frame(spark, "k int, v string, only_t int", (1, "a", 10), (2, "b", 20))
    source = frame(spark, "k int, v string, only_s int", (2, "B", 7), (3, "C", 8))
    got = merge_frames(target, source, "k", **form)
    assert got.columns == ["k", "v", "only_t", "only_s"]
    assert rows(got) == [(1, "a", 10, None), (2, "B", 20, 7), (3, "C", None, 8)]


def test_several_source_rows_for_one_target_row_fail(spark):
    source = frame(spark, "k int, v string", (1, "a"), (1, "b"), (9, "p"), (9, "q"))
    hit = frame(spark, "k int, v string", (1, "x"), (2, "y"))
    with pytest.raises(Exception, match="several source rows"):
        merge_frames(hit, source, "k").collect()
    missed = frame(spark, "k int, v string", (2, "x"), (3, "y"))
    assert merge_frames(missed, source, "k").count() == 6


def test_ambiguity_does_not_matter_without_update(spark):
    source = frame(spark, "k int, v string", (1, "a"), (1, "b"), (9, "p"))
    target = frame(spark, "k int, v string", (1, "x"))
    assert rows(merge_frames(target, source, "k", update="none")) == [(1, "x"), (9, "p")]


@every_form
def test_delete_comes_before_update(spark, form):
    target = frame(spark, "k int, v int", (1, 1), (2, 2), (3, 3))
    source = frame(spark, "k int, v int, d boolean", (1, 10, True), (2, 20, None), (9, 90, True))
    got = merge_frames(target, source, "k", delete_when="source.d", **form).drop("d")
    assert rows(got) == [(2, 20), (3, 3), (9, 90)]
    by_target = merge_frames(target, source, "k", delete_when=F.col("target.v") == 2, insert=False, **form)
    assert rows(by_target.select("k")) == [(1,), (3,)]


@every_form
def test_set_only_changes_matches_and_inserts_nothing(spark, form):
    target = frame(spark, "k int, processed boolean", (1, False), (2, False), (3, None),
                   (None, False))
    source = frame(spark, "k int, n int", (2, 5), (4, 6))
    got = merge_frames(target, source, "k", update={"processed": "true"}, insert=False, **form)
    assert rows(got) == sorted([(1, False), (2, True), (3, None), (None, False)], key=repr)
    computed = merge_frames(
        target, source, "k", update={"processed": F.col("source.n") > 5}, insert=False, **form)
    assert (2, False) in rows(computed)


@every_form
def test_null_keys_are_inserted_each_time(spark, form):
    once = frame(spark, "k int, v int", (None, 1))
    assert rows(merge_frames(once, once, "k", **form)) == [(None, 1), (None, 1)]


@every_form
def test_composite_key_with_null_part_and_other_names(spark, form):
    target = frame(spark, "a int, b int, v int", (1, 1, 1), (1, None, 2))
    source = frame(spark, "x int, y int, v int", (1, 1, 10), (1, None, 20))
    got = merge_frames(target, source, [("a", "x"), ("b", "y")], **form)
    assert rows(got) == sorted([(1, 1, 10), (1, None, 2), (1, None, 20)], key=repr)


@every_form
def test_source_values_take_the_target_type(spark, form):
    target = frame(spark, "k bigint, v int", (1, 1))
    source = frame(spark, "k int, v string", (1, "5"), (2, "6"))
    got = merge_frames(target, source, "k", **form)
    assert got.schema["v"].dataType.simpleString() == "int"
    assert rows(got) == [(1, 5), (2, 6)]


@every_form
def test_names_match_without_regard_to_case(spark, form):
    target = frame(spark, "K int, UF string", (1, "a"))
    source = frame(spark, "k int, uf string", (1, "b"), (2, "c"))
    got = merge_frames(target, source, "K", **form)
    assert got.columns == ["K", "UF"] and rows(got) == [(1, "b"), (2, "c")]


@every_form
def test_odd_column_names(spark, form):
    target = spark.createDataFrame([(1, 2)], ["a.b", "c`d"])
    source = spark.createDataFrame([(1, 3), (4, 5)], ["a.b", "c`d"])
    assert rows(merge_frames(target, source, "a.b", **form)) == [(1, 3), (4, 5)]


def test_a_table_merges_into_itself(spark):
    target = frame(spark, "k int, processed boolean", (1, False), (2, False))
    got = merge_frames(
        target, target.where("k = 1"), "k", update={"processed": "true"}, insert=False)
    assert rows(got) == [(1, True), (2, False)]


def test_arguments_are_checked(spark):
    one = frame(spark, "k int, v int", (1, 1))
    for bad in (
        dict(on=[]), dict(on="nope"), dict(on="k", update="some"),
        dict(on="k", update={"nope": "1"}), dict(on="k", update={}),
        dict(on="k", form="inner", source_unique=True),
    ):
        with pytest.raises(ValueError):
            merge_frames(one, one, **bad)


KEYS = st.one_of(st.none(), st.integers(0, 4))
TABLE = st.lists(st.tuples(KEYS, st.integers(0, 9), st.integers(0, 9)), max_size=8)


def model(target, source, delete, insert, update):
    """The merge in plain Python; None if it must fail."""
    by_key = {}
    for k, v, s in source:
        by_key.setdefault(k, []).append((v, s))
    out = []
    for k, v, t in target:
        hits = [] if k is None else by_key.get(k, [])
        if len(hits) > 1:
            return None
        if not hits:
            out.append((k, v, t, None))
        elif delete and hits[0][0] > 5:
            continue
        elif update:
            out.append((k, hits[0][0], t, hits[0][1]))
        else:
            out.append((k, v, t, None))
    if insert:
        held = {k for k, _, _ in target if k is not None}
        out += [(k, v, None, s) for k, v, s in source if k is None or k not in held]
    return sorted(out, key=repr)


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TABLE, TABLE, st.booleans(), st.booleans(), st.booleans())
def test_merge_agrees_with_the_model(spark, target, source, delete, insert, update):
    if not update and not delete:
        delete = True
    want = model(target, source, delete, insert, update)
    t = spark.createDataFrame(target, "k int, v int, t int").coalesce(1)
    s = spark.createDataFrame(source, "k int, v int, s int").coalesce(1)

    def merged(source_unique, form="probe"):
        got = merge_frames(
            t, s, "k", update="all" if update else "none", insert=insert, form=form,
            delete_when="source.v > 5" if delete else None, source_unique=source_unique)
        return got if "s" in got.columns else got.withColumn("s", F.lit(None).cast("int"))

    if want is None:
        with pytest.raises(Exception, match="several source rows"):
            merged(False).collect()
        return
    assert rows(merged(False)) == want
    keys = [k for k, _, _ in source if k is not None]
    if len(set(keys)) == len(keys):
        assert rows(merged(True)) == want
        assert rows(merged(True, "outer")) == want


def test_outer_form_refuses_repeated_keys(spark):
    target = frame(spark, "k int, v int", (1, 1))
    repeated = frame(spark, "k int, v int", (1, 2), (1, 3))
    with pytest.raises(Exception, match="share one key"):
        merge_frames(target, repeated, "k", form="outer").collect()
    keyless = frame(spark, "k int, v int", (None, 2), (None, 3))
    assert len(rows(merge_frames(target, keyless, "k", form="outer"))) == 3
