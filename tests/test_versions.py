"""One visible version of the table: crashes, readers in between, and writers at the same time."""

import threading
import uuid
from collections import Counter

import pytest

import sessionloom as sl
from helpers import at
from sessionloom.sources import staged, warehouse
from sessionloom.sources.manifest import Manifest
from sessionloom.streaming import load as streaming


@pytest.fixture()
def place(tmp_path):
    name = f"shop_{uuid.uuid4().hex}"
    return {"database": name, "location": str(tmp_path / name)}


def folder(spark, tmp_path, name, customers):
    """Staged files with one event for each customer."""
    rows = [(c, at(c), "view") for c in customers]
    df = spark.createDataFrame(rows, "customer_id long, timestamp timestamp_ntz, type string")
    path = str(tmp_path / name)
    staged.write_staged(sl.sessionize(df, 30), path)
    return path


def seen(spark, place):
    return sorted(r.customer_id for r in warehouse.scan_events(spark, place["database"]).collect())


class Crash(Exception):
    pass


@pytest.mark.parametrize("step", ["before the manifest", "after it"])
def test_a_crash_shows_the_old_rows_or_the_new(spark, tmp_path, place, monkeypatch, step):
    first, second = folder(spark, tmp_path, "a", [1, 2]), folder(spark, tmp_path, "b", [3, 4, 5])
    sl.run_load(spark, first, **place)
    if step == "before the manifest":
        monkeypatch.setattr(Manifest, "_put", lambda *_: (_ for _ in ()).throw(Crash()))
    else:
        monkeypatch.setattr(warehouse, "drop_loads", lambda *_: (_ for _ in ()).throw(Crash()))
    with pytest.raises(Crash):
        sl.run_load(spark, second, **place)
    monkeypatch.undo()
    assert seen(spark, place) == ([1, 2] if step == "before the manifest" else [3, 4, 5])
    name = warehouse.quoted(place["database"], "events")
    left = len(warehouse.loads(spark, name))
    assert left == 2 and seen(spark, place) == seen(spark, place)
    sl.run_load(spark, second, **place)
    assert seen(spark, place) == [3, 4, 5]
    warehouse.remove_unseen(spark, name)
    assert len(warehouse.loads(spark, name)) == 1 and seen(spark, place) == [3, 4, 5]


def test_a_reader_in_between_finishes(spark, tmp_path, place):
    """A frame made before a load gives the rows from before it; one made during it too."""
    first, second = folder(spark, tmp_path, "a", [1, 2]), folder(spark, tmp_path, "b", [3])
    before, during = sl.run_load(spark, first, **place), []
    write = warehouse.write_partition

    def watched(rows, name, part):
        write(rows, name, part)
        during.append(warehouse.scan_events(spark, place["database"]))
        assert during[0].count() == 2

    warehouse.write_partition = watched
    try:
        after = sl.run_load(spark, second, **place)
    finally:
        warehouse.write_partition = write
    assert [df.count() for df in (before, during[0], after)] == [2, 2, 1]
    # After two more loads what the first one showed is gone from the disk.
    sl.run_load(spark, second, **place)
    assert len(warehouse.loads(spark, warehouse.quoted(place["database"], "events"))) <= 2


def test_metrics_count_no_row_twice_while_a_load_is_on(spark, tmp_path, place):
    path, counts = folder(spark, tmp_path, "a", range(20)), []
    sl.run_load(spark, path, **place)
    put = Manifest._put

    def watched(self, version, content):
        counts.append(len(seen(spark, place)))
        done = put(self, version, content)
        counts.append(len(seen(spark, place)))
        return done

    Manifest._put = watched
    try:
        sl.run_load(spark, path, **place)
    finally:
        Manifest._put = put
    assert counts == [20, 20]


def test_a_stream_and_a_batch_at_once_lose_nothing(spark, tmp_path, place):
    """Both change the manifest from the same version; one of them has to look again."""
    name = warehouse.ensure_tables(spark, **place)
    rows = [
        warehouse.as_table_rows(staged.read_staged(spark, folder(spark, tmp_path, str(i), [i])))
        for i in range(4)
    ]
    failed = []

    def load(i):
        try:
            warehouse.publish(rows[i], name, f"load{i}")
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=load, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and seen(spark, place) == [0, 1, 2, 3]
    warehouse.publish(rows[0], name, "load3")
    assert seen(spark, place) == [0, 0, 1, 2]


def test_a_table_without_a_manifest(spark, tmp_path, place):
    name = warehouse.ensure_tables(spark, **place)
    rows = warehouse.as_table_rows(staged.read_staged(spark, folder(spark, tmp_path, "a", [1])))
    assert seen(spark, place) == []
    for load in ("x", "y"):
        warehouse.replace_load(rows, name, load)
    assert seen(spark, place) == [1, 1]
    warehouse.publish(rows, name, "z")
    assert seen(spark, place) == [1, 1, 1]
    warehouse.publish(rows, name, "x", keep=lambda other: other == "x")
    assert seen(spark, place) == [1]


def test_stream_batches_that_are_tried_again(spark, tmp_path, place, monkeypatch):
    path, check = folder(spark, tmp_path, "a", [1, 2, 3]), str(tmp_path / "ck")
    put, tries = Manifest._put, []

    def crash_once(self, version, content):
        done = put(self, version, content)
        tries.append(version)
        if len(tries) == 1:
            raise Crash
        return done

    monkeypatch.setattr(Manifest, "_put", crash_once)
    with pytest.raises(Exception, match="Crash"):
        streaming.stream_load(spark, path, check, **place, available_now=True).awaitTermination()
    assert seen(spark, place) == [1, 2, 3]
    streaming.stream_load(spark, path, check, **place, available_now=True).awaitTermination()
    assert seen(spark, place) == [1, 2, 3] and len(tries) == 2


def test_manifest_versions(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path / "m"))
    assert manifest.read() == (0, {}) and manifest.versions() == []
    for i in range(14):
        manifest.change(lambda held: held | {str(i): i})
    assert manifest.read()[0] == 14 and len(manifest.read()[1]) == 14 and len(manifest.versions()) <= 11
    assert not manifest._put(14, {})
    asked = Counter()

    def slow(held):
        asked["n"] += 1
        if asked["n"] == 1:
            Manifest(spark, manifest.folder).change(lambda h: h | {"other": 1})
        return held | {"mine": 1}

    manifest.change(slow)
    assert asked["n"] == 2 and {"other", "mine"} <= set(manifest.read()[1])
