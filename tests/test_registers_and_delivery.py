"""The status log with snapshots, delivery without repetition, and reading databases in ranges and by key."""

import itertools
import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from kerbsight.operators.status_log import StatusLog
from kerbsight.sources import readers
from kerbsight.sources.outbox import NotSent, deliver_once

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this file

# --- status log ---


def entries(spark, rows):
    return spark.createDataFrame([(i, s, None if m is None else f"2024-01-01 10:{m:02d}:00") for i, s, m in rows], "detection_id long, status string, t string").select("detection_id", "status", F.to_timestamp("t").alias("processed_at"))


def plain(batches):
    last = {}
    for k, rows in batches.items():
        for i, s, m in rows:
            if i is not None:
                e = (-1 if m is None else m, k, s)
                last[i] = max(last.get(i, e), e)
    return {i: s for i, (_, _, s) in last.items()}


def some_batches(seed, n=6):
    r = random.Random(seed)
    return {k: [(r.choice([*range(12), None]), r.choice("ABC"), r.choice([*range(30), None])) for _ in range(r.choice([1, 5, 20]))] for k in range(1, n + 1)}


@pytest.mark.parametrize(("seed", "compact_at"), [(0, {2, 5}), (1, {1, 2, 3, 4, 5, 6}), (2, set())])
def test_snapshot_and_tail_equal_the_whole_log(spark, tmp_path, seed, compact_at):
    log, batches = StatusLog(spark, str(tmp_path / "log")), some_batches(seed)
    assert log.current().count() == 0 and log.compact() == 0
    done = {}
    for k, rows in batches.items():
        assert log.append(entries(spark, rows)) == k
        done[k] = rows
        if k in compact_at:
            assert log.compact() == k
        assert {r.detection_id: r.status for r in log.current().collect()} == plain(done)
    rows = spark.createDataFrame([(i, "own", "x") for i in range(15)], "detection_id long, status string, more string")
    got = {r.detection_id: r.status for r in log.with_status(rows).collect()}
    assert got == {i: plain(done).get(i, "own") for i in range(15)}
    if compact_at:
        log.drop_folded()
        assert {r.detection_id: r.status for r in log.current().collect()} == plain(done)


def test_reads_touch_the_snapshot_and_the_tail_only(spark, tmp_path):
    log = StatusLog(spark, str(tmp_path / "log"))
    for k in range(1, 6):
        log.append(entries(spark, [(k, "A", k)]))
    log.compact()
    log.append(entries(spark, [(1, "B", 50)]))
    read = {f.split("/log/")[1].rsplit("/", 1)[0] for f in log.current().inputFiles()}
    assert read == {"snapshots/upto=5", "entries/batch=6"}
    with pytest.raises(ValueError, match="snapshot up to 5"):
        log.append(entries(spark, [(1, "C", 1)]), batch=5)
    assert log.drop_folded() == [1, 2, 3, 4, 5] and log.watermark() == 5
    assert {r.detection_id: r.status for r in log.current().collect()} == {1: "B", 2: "A", 3: "A", 4: "A", 5: "A"}


def test_batches_and_snapshots_that_died_are_not_read(spark, tmp_path):
    log = StatusLog(spark, str(tmp_path / "log"))
    log.append(entries(spark, [(1, "A", 1)]))
    log.append(entries(spark, [(1, "B", 2), (2, "B", 2)]))
    log.compact()
    log.append(entries(spark, [(2, "C", 3)]))
    log.append(entries(spark, [(3, "D", 3)]))
    log.compact()
    os.remove(tmp_path / "log/snapshots/upto=4/_SUCCESS")
    os.remove(tmp_path / "log/entries/batch=4/_SUCCESS")
    assert {r.detection_id: r.status for r in log.current().collect()} == {1: "B", 2: "C"}
    log.append(entries(spark, [(3, "E", 3)]), batch=4)  # the job is repeated
    assert log.compact() == 4
    assert {r.detection_id: r.status for r in log.current().collect()} == {1: "B", 2: "C", 3: "E"}


# --- delivery ---


class Service:
    """Notes every call in a file; what it says depends on the id."""

    def __init__(self, path, die_at=None, refuse=(), fail=()):
        self.path, self.die_at, self.refuse, self.fail = str(path), die_at, refuse, fail

    def calls(self):
        return open(self.path).read().split() if os.path.exists(self.path) else []

    def send(self, row):
        if row["id"] in self.refuse:
            raise NotSent
        with open(self.path, "a") as f:
            f.write(f"{row['id']}\n")
        if row["id"] == self.die_at:
            os._exit(1)
        if row["id"] in self.fail:
            raise ConnectionError
        return f"S{row['id']}"

    def lookup(self, row):
        return f"S{row['id']}" if str(row["id"]) in self.calls() else None


def outcomes(df):
    return {r.id: (r.outcome, r.signal_id) for r in df.collect()}


def test_nothing_is_sent_twice(spark, tmp_path):
    folder, service = f"file://{tmp_path}/outbox", Service(tmp_path / "calls", refuse=(3,), fail=(4,))
    rows = spark.createDataFrame([(1,), (2,), (2,), (3,), (4,), (None,)], "id long")
    first = deliver_once(rows, service.send, folder, parts=3)
    want = {1: ("sent", "S1"), 2: ("sent", "S2"), 3: ("failed", None), 4: ("unknown", None), None: ("failed", None)}
    assert first.count() == 6 and outcomes(first) == want and outcomes(first) == want
    assert sorted(service.calls()) == ["1", "2", "4"]
    service.refuse = service.fail = ()
    again = deliver_once(rows, service.send, folder, parts=3)
    assert outcomes(again) == want | {3: ("sent", "S3")} and sorted(service.calls()) == ["1", "2", "3", "4"]
    assert outcomes(deliver_once(rows, service.send, folder, lookup=service.lookup, parts=3))[4] == ("sent", "S4")
    assert sorted(service.calls()) == ["1", "2", "3", "4"]


@pytest.mark.parametrize("chunk", [1, 4])
def test_a_task_that_dies_midway_is_repeated_without_sending_again(spark, tmp_path, chunk):
    folder, dying = f"file://{tmp_path}/outbox", Service(tmp_path / "calls", die_at=7)
    rows = spark.range(1, 21).coalesce(1)
    with pytest.raises(Exception, match="exited|crashed|EOF"):
        deliver_once(rows, dying.send, folder, parts=1, chunk=chunk).collect()
    sent = dying.calls()
    assert "7" in sent and len(sent) < 20
    blind = outcomes(deliver_once(rows, Service(tmp_path / "calls").send, folder, parts=1, chunk=chunk))
    calls = dying.calls()
    assert len(calls) == len(set(calls)) and {i for i, (o, _) in blind.items() if o == "unknown"} >= {7}
    assert len([1 for o, _ in blind.values() if o == "unknown"]) <= chunk
    service = Service(tmp_path / "calls")
    asked = outcomes(deliver_once(rows, service.send, folder, lookup=service.lookup, parts=1, chunk=chunk))
    assert asked == {i: ("sent", f"S{i}") for i in range(1, 21)}
    assert sorted(map(int, service.calls())) == list(range(1, 21))


def test_speculative_tasks_are_refused(spark, monkeypatch):
    class Conf:
        def get(self, *_):
            return "true"

    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: Conf())
    with pytest.raises(ValueError, match="speculation"):
        deliver_once(spark.range(1), lambda row: None, "file:///nowhere")


# --- databases ---

_names = itertools.count()


@pytest.fixture
def database(spark):
    """An embedded database in this JVM, with a table of places."""
    url = f"jdbc:derby:memory:places{next(_names)};create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    spark._jvm.java.lang.Class.forName(driver)
    con = spark._jvm.java.sql.DriverManager.getConnection(url)
    run = con.createStatement().executeUpdate
    run("create table places (id int, street varchar(40), number int, postcode varchar(10))")
    for k in range(300):
        run(f"insert into places values ({k * k}, 'O''Neill {k % 7}', {k}, '{1000 + k % 9}AB')")
    run("insert into places values (null, 'nowhere', 1, null)")
    yield url, driver
    con.close()


def test_ranges_of_a_key_leave_nothing_out(spark, database):
    url, driver = database
    whole = readers.jdbc_ranges(spark, url, "select * from places", "id", rows_each=40, driver=driver)
    assert whole.rdd.getNumPartitions() == 8 and whole.count() == 301 and whole.distinct().count() == 301
    assert readers.jdbc_ranges(spark, url, "select * from places", "id", rows_each=40, most=3, driver=driver).rdd.getNumPartitions() == 3
    few = readers.jdbc_ranges(spark, url, "select * from places where number = 5", "id", rows_each=1, driver=driver)
    assert few.rdd.getNumPartitions() == 1 and few.count() == 1
    assert readers.jdbc_ranges(spark, url, "select * from places where number < 0", "id", driver=driver).count() == 0


@pytest.mark.parametrize("most_keys", [1000, 2])
def test_lookups_by_id_and_by_address(spark, database, most_keys):
    url, driver = database
    ids = spark.createDataFrame([(k,) for k in (0, 1, 4, 5, 9, 81, 81, None)], "id int")
    got = readers.jdbc_lookup(spark, url, "select * from places", ids, batch=2, most_keys=most_keys, range_key="id", driver=driver)
    assert sorted(r[0] for r in got.collect()) == [0, 1, 4, 9, 81]
    if most_keys > 2:
        assert got.rdd.getNumPartitions() == 3
    keys = spark.createDataFrame([("O'Neill 3", 3), ("O'Neill 3", 10), ("O'Neill 3", 4), ("' or 1 = 1 --", 1), (None, 1)], "street string, number int")
    got = readers.jdbc_lookup(spark, url, "select * from places", keys, most_keys=most_keys, driver=driver)
    assert sorted(r["NUMBER"] for r in got.collect()) == [3, 10]
    none = readers.jdbc_lookup(spark, url, "select * from places", ids.limit(0), driver=driver)
    assert none.count() == 0 and len(none.columns) == 4
