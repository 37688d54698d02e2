from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom import load_table, paths, store_table, table_path
from ledgerloom.layers import Version, current_version, publish, sweep
from ledgerloom.tables import INT, STRING, T
from tests.conftest import bag

SCHEMA = T.StructType([T.StructField("k", INT), T.StructField("v", STRING)])


@pytest.fixture
def path(data_dir):
    return table_path(data_dir, "raw", "things")


@pytest.fixture
def old(spark):
    return spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA)


@pytest.fixture
def broken(old):
    """Fails only once its rows are computed."""
    return old.select("k", F.concat(F.lit("x"), "v").cast("int").cast("string").alias("v"))


def leftovers(path):
    return [name for name in os.listdir(os.path.dirname(path)) if name.startswith("_")]


def test_path_of_a_table(data_dir):
    assert table_path("/data/", "enriched", "orders") == "/data/enriched/orders.parquet"


@pytest.mark.parametrize("staging", ["swap", "direct"])
def test_store_replaces_the_table(spark, path, old, staging):
    assert store_table(old, path, staging) is True
    assert store_table(old.where("k = 2"), path, staging) is True
    assert bag(load_table(spark, path, SCHEMA)) == [(2, "b")]
    assert leftovers(path) == []


def test_column_names_may_have_spaces(spark, path):
    schema = T.StructType([T.StructField("Product ID", STRING)])
    store_table(spark.createDataFrame([("P1",)], schema), path)
    assert bag(load_table(spark, path, schema)) == [("P1",)]


def test_frame_may_read_the_table_it_replaces(spark, path, old):
    store_table(old, path)
    store_table(load_table(spark, path, SCHEMA).where("k = 1"), path)
    assert bag(load_table(spark, path, SCHEMA)) == [(1, "a")]


def test_failed_store_keeps_the_old_table(spark, path, old, broken):
    store_table(old, path)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        store_table(broken, path)
    assert bag(load_table(spark, path, SCHEMA)) == [(1, "a"), (2, "b")]
    assert leftovers(path) == []


@pytest.mark.parametrize("staging", ["swap", "direct"])
def test_failed_store_keeps_the_old_table_however_it_is_staged(spark, path, old, broken, staging):
    store_table(old, path, staging)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        store_table(broken, path, staging)
    assert bag(load_table(spark, path, SCHEMA)) == [(1, "a"), (2, "b")]
    assert len(os.listdir(f"{path}/_versions")) == 1


def test_failed_first_store_leaves_nothing(path, broken):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        store_table(broken, path)
    assert not os.path.exists(path)


def test_failed_pointer_keeps_the_old_table(spark, path, old, monkeypatch):
    store_table(old, path)

    def fail(*_):
        raise OSError("no rename")

    monkeypatch.setattr(paths, "_rename_over", fail)
    with pytest.raises(OSError):
        store_table(old.where("k = 1"), path)
    assert bag(load_table(spark, path, SCHEMA)) == [(1, "a"), (2, "b")]
    assert not [name for name in os.listdir(path) if name.startswith("_put")]


class Killed(BaseException):
    """The driver is lost: no handler and no cleaning up runs."""


STEPS = ["children", "exists", "read_text", "put_text", "_rename_over", "newest_change", "delete"]


@pytest.mark.parametrize(("staging", "moment"), [("swap", "before"), ("swap", "after"), ("direct", "after")])
def test_readers_see_the_old_or_the_new_table_wherever_the_driver_is_lost(
    spark, path, old, monkeypatch, staging, moment
):
    """The store ends before or after each of its steps on the file system in turn."""
    old, new = old.coalesce(1), old.where("k = 2").coalesce(1)
    seen = []
    for last_step in range(100):
        table = f"{path}-{last_step}"
        store_table(old, table, staging)
        steps = iter(range(100))
        with monkeypatch.context() as patch:
            for name in STEPS:

                def step(*args, _do=getattr(paths, name), **kwargs):
                    number = next(steps)
                    if number == last_step and moment == "before":
                        raise Killed
                    result = _do(*args, **kwargs)
                    if number == last_step:
                        raise Killed
                    return result

                patch.setattr(paths, name, step)
            try:
                store_table(new, table, staging, sweep_hours=0)
                done = True
            except Killed:
                done = False
        seen.append(bag(load_table(spark, table, SCHEMA, on_missing="empty")))
        if done:
            break
    assert done and len(seen) > 8
    first = seen.index([(2, "b")])
    assert seen[:first] == [[(1, "a"), (2, "b")]] * first
    assert seen[first:] == [[(2, "b")]] * (len(seen) - first)
    assert os.listdir(f"{table}/_versions") == [current_version(spark, table).name]


def test_a_job_that_is_lost_leaves_the_old_table(spark, path, old, monkeypatch):
    store_table(old, path)

    def lose(writer, target):
        writer.mode("overwrite").format("parquet").save(target)
        os.remove(f"{target}/_SUCCESS")
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr("pyspark.sql.readwriter.DataFrameWriter.parquet", lose)
        with pytest.raises(Killed):
            store_table(old.where("k = 1"), path)
    assert bag(load_table(spark, path, SCHEMA)) == bag(old)
    assert len(os.listdir(f"{path}/_versions")) == 2
    store_table(old.where("k = 2"), path, sweep_hours=0)
    assert len(os.listdir(f"{path}/_versions")) == 1


@pytest.mark.parametrize("text", ["", "{", '{"name"', "[]", '{"other": 1}'])
def test_a_pointer_cut_short_leads_to_the_newest_finished_version(spark, path, old, text):
    store_table(old, path)
    store_table(old.where("k = 2"), path)
    os.makedirs(f"{path}/_versions/00000009-unfinished")
    with open(f"{path}/_current", "w") as pointer:
        pointer.write(text)
    assert bag(load_table(spark, path, SCHEMA)) == [(2, "b")]


def test_a_pointer_without_its_version_is_an_error(spark, path, old):
    store_table(old, path)
    os.rename(f"{path}/_versions", f"{path}/_elsewhere")
    for policy in ("raise", "empty"):
        with pytest.raises(FileNotFoundError, match="isn't there"):
            load_table(spark, path, SCHEMA, on_missing=policy)


def test_only_finished_versions_are_published(spark, path, old):
    store_table(old, path)
    with pytest.raises(FileNotFoundError, match="finished"):
        publish(spark, path, Version("00000007-none"))
    assert bag(load_table(spark, path, SCHEMA)) == bag(old)


def test_a_frame_goes_on_reading_the_version_it_began_with(spark, path, old):
    store_table(old, path)
    before = load_table(spark, path, SCHEMA)
    store_table(old.where("k = 1"), path)
    assert bag(before) == bag(old)
    assert bag(load_table(spark, path, SCHEMA)) == [(1, "a")]


def test_sweeping_goes_by_age(spark, path, old):
    for _ in range(3):
        store_table(old, path)
    assert sweep(spark, path) == []
    assert len(os.listdir(f"{path}/_versions")) == 3
    long_ago = 1_500_000_000
    first = sorted(os.listdir(f"{path}/_versions"))[0]
    for folder, _, files in os.walk(f"{path}/_versions/{first}"):
        for name in [*files, "."]:
            os.utime(f"{folder}/{name}", (long_ago, long_ago))
    assert [gone.split("/")[-1] for gone in sweep(spark, path)] == [first]
    assert len(sweep(spark, path, older_than_hours=0)) == 1
    assert os.listdir(f"{path}/_versions") == [current_version(spark, path).name]
    assert bag(load_table(spark, path, SCHEMA)) == bag(old)


def test_a_plain_parquet_folder_is_read_and_then_replaced(spark, path, old):
    old.write.parquet(path)
    assert bag(load_table(spark, path, SCHEMA)) == bag(old)
    store_table(load_table(spark, path, SCHEMA).where("k = 1"), path, sweep_hours=0)
    assert bag(load_table(spark, path, SCHEMA)) == [(1, "a")]
    assert not [name for name in os.listdir(path) if name.startswith("part-")]


def test_overwriting_a_pointer_through_the_file_context(spark, tmp_path, monkeypatch):
    """As on HDFS, whose plain rename doesn't overwrite."""
    monkeypatch.setattr(paths, "_without_checksums", NotLocal)
    for text in ("one", "two"):
        paths.put_text(spark, str(tmp_path / "pointer"), text)
        assert (tmp_path / "pointer").read_text() == text


class NotLocal:
    """A file system that says it isn't the local one."""

    def __init__(self, fs):
        self._fs = fs

    def __getattr__(self, name):
        return getattr(self._fs, name)

    def getUri(self):  # noqa: N802
        return self

    def getScheme(self):  # noqa: N802
        return "hdfs"


def test_failure_as_a_flag(path, broken):
    assert store_table(broken, path, on_error="flag") is False


def test_missing_table(spark, path):
    with pytest.raises(FileNotFoundError):
        load_table(spark, path, SCHEMA)
    empty = load_table(spark, path, SCHEMA, on_missing="empty")
    assert (empty.schema, empty.count()) == (SCHEMA, 0)


@pytest.mark.parametrize("columns", [["k"], ["k", "cast(k as string) as other"], ["k", "k as v"]])
def test_stored_columns_must_match_the_declaration(spark, path, old, columns):
    store_table(old.selectExpr(columns), path)
    with pytest.raises(ValueError, match="declared columns"):
        load_table(spark, path, SCHEMA, on_missing="empty")


def test_columns_come_in_declared_order_without_extras(spark, path, old):
    store_table(old.selectExpr("v", "k", "k as more"), path)
    assert load_table(spark, path, SCHEMA).schema == SCHEMA


def test_data_without_a_marker_is_never_taken_for_empty(spark, path, old):
    old.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    assert "_SUCCESS" not in os.listdir(path)
    with pytest.raises(FileNotFoundError):
        load_table(spark, path, SCHEMA)
    assert bag(load_table(spark, path, SCHEMA, on_missing="empty")) == bag(old)


def test_a_folder_without_data_is_missing(spark, path):
    os.makedirs(f"{path}/_temporary/0")
    assert load_table(spark, path, SCHEMA, on_missing="empty").count() == 0
    with pytest.raises(FileNotFoundError):
        load_table(spark, path, SCHEMA)


def test_tables_are_stored_with_a_strong_compression(spark, tmp_path):
    path = str(tmp_path / "table")
    store_table(spark.range(3), path)
    assert list((tmp_path / "table").glob("_versions/*/part-*.zstd.parquet"))
    assert load_table(spark, path, spark.range(3).schema).count() == 3
