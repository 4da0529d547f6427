"""The keyed store and its versions."""

import os

import pytest
from pyspark.sql import functions as F

from entries import QUERIES
from urbanweave.session import scratch_path
from urbanweave.sources import store
from urbanweave.sources.snapshots import CommitConflict, SnapshotLog

SCHEMA = "bucket int, device string, start long, end long, isReal boolean, value double"


def load(spark, rows):
    return spark.createDataFrame([(start // 100 % 4, device, start, start + 1, True, float(value)) for device, start, value in rows], SCHEMA)


def stored(spark, paths, version=None):
    found = [sorted((r.device, r.start, r.value) for r in store.read_series(spark, p, version=version).collect()) for p in paths.values()]
    assert found[0] == found[1]
    return found[0]


def test_a_backfill_overwrites_its_keys(spark, tmp_path):
    put = lambda rows, mode="merge": store.write_dual_layout(load(spark, rows), str(tmp_path), "p", "PT1H", "u", mode=mode)
    paths = put([("a", 10, 1), ("a", 110, 2), ("b", 10, 3), ("a", 420, 4)], "errorifexists")
    put([("a", 10, 5), ("c", 120, 6), ("c", 120, 7)])
    assert stored(spark, paths) == [("a", 10, 5), ("a", 110, 2), ("a", 420, 4), ("b", 10, 3), ("c", 120, 7)]
    put([("a", 10, 5), ("c", 120, 6), ("c", 120, 7)])  # again: nothing doubles
    assert len(stored(spark, paths)) == 5
    with pytest.raises(ValueError):
        put([("z", 300, 1), ("b", 10, 8)], "append")
    with pytest.raises(FileExistsError):
        put([("z", 300, 1)], "errorifexists")
    put([("z", 300, 1)], "append")
    assert stored(spark, paths)[-1] == ("z", 300, 1) and stored(spark, paths, 1) == [("a", 10, 1), ("a", 110, 2), ("a", 420, 4), ("b", 10, 3)]
    assert store.stored_buckets(spark, paths["batch"]) == [0, 1, 3]
    before = stored(spark, paths)
    store.compact_series(spark, paths["online"])
    assert stored(spark, paths) == before and len({f["load"] for f in store._log(spark, paths["batch"]).snapshot().folders.values()}) == 1
    planned = store.read_series(spark, paths["online"], version=2)
    assert planned.count() == 5
    assert store.clean_series(spark, paths["online"], delay=3600) == [] and planned.count() == 5
    assert store.clean_series(spark, paths["online"], delay=-10) and stored(spark, paths) == before
    assert store.read_series(spark, paths["online"], [2]).count() == 0


def test_events_of_one_second_are_told_apart_by_a_longer_key(spark, tmp_path):
    def put(rows, mode):
        made = load(spark, [(d, t, v) for d, t, v, _ in rows]).withColumn("event", F.col("value").cast("long") % 10)
        assert [r.event for r in made.collect()] == [e for *_, e in rows]
        return store.write_dual_layout(made, str(tmp_path), "p", "PT1H", "u", mode=mode, key=(*store.KEY, "event"))

    put([("a", 10, 1, 1), ("a", 10, 2, 2)], "append")
    paths = put([("a", 10, 3, 3), ("b", 10, 1, 1)], "append")
    assert stored(spark, paths) == [("a", 10, 1), ("a", 10, 2), ("a", 10, 3), ("b", 10, 1)]
    with pytest.raises(ValueError):
        put([("a", 10, 12, 2)], "append")
    put([("a", 10, 12, 2), ("a", 10, 22, 2), ("c", 10, 4, 4)], "merge")
    assert stored(spark, paths) == [("a", 10, 1), ("a", 10, 3), ("a", 10, 22), ("b", 10, 1), ("c", 10, 4)]


def test_append_query_keeps_events_of_one_second(spark, tmp_path):
    """Events of two loads that share user and second."""
    at = "timestamp '2024-01-03 10:00:00.25'"
    spark.sql(f"select * from values (0L, {at}, 7L, 1.0D), (1L, {at} + interval 100 milliseconds, 7L, 2.0D), (2L, {at}, 8L, 4.0D) as e(event_id, ts, user_id, value)").write.parquet(
        f"{tmp_path}/events.parquet")
    got = QUERIES["write_dual_layout_append"](spark, str(tmp_path)).collect()
    assert sorted((r.layout, r.n, r.devices, r.value) for r in got) == [(layout, 1, 1, v) for layout in ("batch", "online") for v in (1.0, 2.0, 4.0)]


def test_rows_without_device_or_start_are_keys_too(spark, tmp_path):
    rows = spark.createDataFrame([(None, "a", None, None, True, 1.0), (1, None, 5, 6, True, 2.0)], SCHEMA)
    for factor in (1, 10):
        paths = store.write_dual_layout(rows.withColumn("value", F.col("value") * factor), str(tmp_path), "p", "PT1H", "u", mode="merge")
    for path in paths.values():
        assert sorted((r.device, r.value) for r in store.read_series(spark, path).collect() if r.device) == [("a", 10.0)]
        assert store.read_series(spark, path).count() == 2


def test_only_touched_cells_are_written_again(spark, tmp_path):
    first = store.write_dual_layout(load(spark, [("a", 10, 1), ("a", 110, 1), ("a", 210, 1)]), str(tmp_path), "p", "PT1H", "u")
    before = set(store._log(spark, first["online"]).snapshot().folders)
    store.write_dual_layout(load(spark, [("b", 10, 2), ("a", 110, 2)]), str(tmp_path), "p", "PT1H", "u", mode="merge")
    after = set(store._log(spark, first["online"]).snapshot().folders)
    assert {name.rsplit("=", 1)[1] for name in before - after} == {"1"} and len(before & after) == 4


def test_a_load_that_fails_leaves_nothing(spark, tmp_path, monkeypatch):
    paths = store.write_dual_layout(load(spark, [("a", 10, 1)]), str(tmp_path), "p", "PT1H", "u")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(store, "_publish", lost)
        with pytest.raises(RuntimeError):
            store.write_dual_layout(load(spark, [("a", 10, 2)]), str(tmp_path), "p", "PT1H", "u", mode="merge")
    assert stored(spark, paths) == [("a", 10, 1)]
    store.write_dual_layout(load(spark, [("a", 10, 2)]), str(tmp_path), "p", "PT1H", "u", mode="merge")
    assert stored(spark, paths) == [("a", 10, 2)]


def test_a_load_published_meanwhile_is_seen(spark, tmp_path, monkeypatch):
    paths = store.write_dual_layout(load(spark, [("a", 10, 1)]), str(tmp_path), "p", "PT1H", "u")
    publish, calls = store._publish, []

    def later(*given):
        if not calls:
            calls.append(1)
            store.write_dual_layout(load(spark, [("b", 20, 7), ("a", 10, 7)]), str(tmp_path), "p", "PT1H", "u", mode="merge")
        return publish(*given)

    monkeypatch.setattr(store, "_publish", later)
    store.write_dual_layout(load(spark, [("a", 10, 2), ("b", 21, 2)]), str(tmp_path), "p", "PT1H", "u", mode="merge")
    assert stored(spark, paths) == [("a", 10, 2), ("b", 20, 7), ("b", 21, 2)]


def test_versions_of_a_log(spark):
    log = SnapshotLog(spark, scratch_path(spark, "log"))
    assert log.snapshot().version == 0 and log.clean(0) == []
    empty = log.snapshot()
    for k in range(40):
        log.commit(log.snapshot(), {f"f{k}": {"n": k}}, [f"f{k - 1}"] if k % 3 == 1 else [])
    latest = log.snapshot()
    assert latest.version == 40 and set(latest.folders) == {f"f{k}" for k in range(40) if not ((k + 1) % 3 == 1 and k < 39)}
    assert latest.folders["f7"] == {"n": 7, "order": 8} and set(log.snapshot(2).folders) == {"f1"}
    assert log.commit_after(empty, {"late": {}}) is None
    assert log.commit(empty, {"late": {}}) == 41
    with pytest.raises(CommitConflict):
        log.commit(empty, {"x": {}}, ["f0"])
    with pytest.raises(ValueError):
        log.snapshot(99)
    assert not [f for f in os.listdir(log.path.removeprefix("file:")) if f.startswith("draft")]
