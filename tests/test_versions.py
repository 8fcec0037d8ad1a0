"""Versioned commits: whenever a writer ends, and whoever else writes."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from corpusflow.shipping import ship
from corpusflow.sources import sinks, versions


@pytest.fixture(scope="module")
def source(spark):
    ship(spark)
    spark.dataSource.register(versions.Versions)
    return spark


def put(df, path, expected):
    df.write.format("versions").option("expected", expected).mode("append").save(path)


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_versions_as_a_source(source, tmp_path):
    path, df = str(tmp_path / "t"), source.range(10).withColumn("t", F.array(F.col("id").cast("string")))
    put(df.repartition(3), path, 0)
    put(df.filter("id > 6"), path, 1)
    put(df.limit(0), path, 2)
    load = lambda **o: source.read.format("versions").options(**o).load(path)
    assert ids(load(version=1)) == list(range(10)) and ids(load(version=2)) == [7, 8, 9] and load().count() == 0 and load().schema == df.schema
    assert load(version=2).filter("id = 8").first()["t"] == ["8"]
    assert ids(sinks.read_version(source, path, 2)) == [7, 8, 9] and sinks.read_version(source, path).schema.names == ["id", "t"]
    with pytest.raises(Exception, match="no longer the latest"):
        put(df, path, 1)
    assert len(list((tmp_path / "t").glob("data-*"))) == 2  # what lost the race is gone
    assert sinks.commit(df.limit(1), path, 3) == 4 and sinks.read_version(source, path).count() == 1


def test_a_failed_task_leaves_nothing(source, tmp_path):
    path = str(tmp_path / "t")
    put(source.range(3), path, 0)
    with pytest.raises(Exception, match="broken"):
        put(source.range(0, 40, 1, 4).select(F.when(F.col("id") < 39, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("id")), path, 1)
    assert sinks.current_version(source, path) == 1 and ids(sinks.read_version(source, path)) == [0, 1, 2]
    for _ in range(20):  # a task that still ran may leave its file
        versions.vacuum(path, older=0)
        time.sleep(0.5)
    assert len(list((tmp_path / "t").glob("data-*"))) == 1 and ids(sinks.read_version(source, path)) == [0, 1, 2]
    (tmp_path / "t" / "data-young").mkdir()
    assert versions.vacuum(path) == [] and versions.vacuum(path, now=lambda: 4e9) == ["data-young"]


@pytest.mark.parametrize("left", ["", '{"data": "da', "{}", "[1]"])
def test_a_torn_marker_is_no_version(source, tmp_path, left):
    path = str(tmp_path / "t")
    sinks.commit(source.range(3), path, 0)
    (tmp_path / "t" / "commit-2").write_text(left)  # a writer that ended between creating and writing
    (tmp_path / "t" / ".commit-2.abc").write_text("x")  # and one before its marker took its name
    (tmp_path / "t" / "data-orphan").mkdir()  # and one before that
    assert sinks.current_version(source, path) == 1 and ids(sinks.read_version(source, path)) == [0, 1, 2]
    assert sinks.commit(source.range(5), path, 1) == 3 and sinks.read_version(source, path).count() == 5 and sinks.current_version(source, path) == 3
    with pytest.raises(FileNotFoundError):
        sinks.read_version(source, path, 2)


def test_markers_that_are_a_path(source, tmp_path):
    source.range(4).write.parquet(str(tmp_path / "t" / "data-1-x"))
    (tmp_path / "t" / "commit-1").write_text(str(tmp_path / "t" / "data-1-x"))
    assert sinks.read_version(source, str(tmp_path / "t")).count() == 4


@pytest.mark.parametrize("kind", [versions.Folder, versions.HadoopFolder])
def test_of_racing_writers_one_wins(source, tmp_path, kind):
    path = str(tmp_path / kind.__name__)
    for version in range(5):
        at, won, start = [kind(path) if kind is versions.Folder else kind(source, path) for _ in range(8 if kind is versions.Folder else 1)], [], threading.Barrier(8 if kind is versions.Folder else 1)

        def race(k, at=at, won=won, start=start, version=version):
            start.wait()
            try:
                won.append((k, versions.publish(at[k], version, {"data": f"of-{k}"})))
            except versions.Conflict:
                pass

        runs = [threading.Thread(target=race, args=(k,)) for k in range(len(at))]
        [t.start() for t in runs]
        [t.join() for t in runs]
        assert len(won) == 1 and won[0][1] == version + 1 and versions.marker(at[0], None) == {"data": f"of-{won[0][0]}"}
    with pytest.raises(versions.Conflict):
        versions.publish(at[0], 2, {"data": "late"})
    assert not at[0].put("commit-5", "again") and not [n for n in at[0].names() if n.startswith(".commit")]


def test_only_mounted_folders(source):
    assert versions.local("file:///a/b") == versions.local("/a/b") == versions.local("file:/a/b")
    with pytest.raises(ValueError):
        versions.local("s3://bucket/x")
