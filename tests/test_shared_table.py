"""One table for many writers: jobs that stop halfway, replays, compaction."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from movelake.operators import layout, ledger, sinks
from movelake.session import scratch_path
from movelake.sources import standin

AS_OF = dt.datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def flights(spark):
    path = scratch_path(spark, "given")
    standin.flights(spark, "/root/testdata/sf0.001").write.parquet(path)
    return spark.read.parquet(path)


class Stop(Exception):
    pass


def stopping(monkeypatch, method, after):
    """The next calls of a file operation work ``after`` times, then the job stops."""
    left, real = [after], getattr(ledger._Files, method)

    def call(self, *a):
        if left[0] == 0:
            raise Stop
        left[0] -= 1
        return real(self, *a)

    monkeypatch.setattr(ledger._Files, method, call)


def ids(spark, path):
    return sorted((r.icao24, r.timestamp, r.source) for r in sinks.read_table(spark, path, "flights").select("icao24", "timestamp", "source").collect())


@pytest.mark.parametrize("method,after", [("move", 0), ("move", 1), ("move", 2), ("move", 4), ("put", 0), ("put", 1), ("delete", 0)])
def test_a_batch_that_stops_halfway_is_finished_by_its_replay(spark, flights, monkeypatch, method, after):
    path = scratch_path(spark, "shared")
    rows = layout.with_chunk(sinks.prepare(flights, "flights"), "flights")
    with monkeypatch.context() as m:
        stopping(m, method, after)
        with pytest.raises(Stop):
            ledger.publish(rows, path, "w", 3)
    again = ledger.publish(rows, path, "w", 3)
    assert again["rows"] == flights.count() and not ledger.publish(rows, path, "w", 3)["new"]
    assert sinks.read_table(spark, path, "flights").count() == flights.count()
    assert [(r.writer, r.batch, r.rows) for r in ledger.entries(spark, path).collect()] == [("w", "3", flights.count())]


@pytest.mark.parametrize("method,after", [("put", 0), ("move", 2), ("move", 20), ("put", 1), ("delete", 0), ("delete", 3), ("delete", 40)])
def test_readers_see_every_row_once_while_a_compaction_is_halfway(spark, flights, monkeypatch, method, after):
    path = scratch_path(spark, "shared")
    for part in ("source = 'opensky'", "source != 'opensky'"):  # some files a chunk
        sinks.append(flights.where(part), path, "flights")
    want = ids(spark, path)
    with monkeypatch.context() as m:
        stopping(m, method, after)
        try:
            layout.compact_chunks(spark, path, "flights", AS_OF)
        except Stop:
            pass
        assert ids(spark, path) == want
    layout.compact_chunks(spark, path, "flights", AS_OF)
    assert ids(spark, path) == want and not ledger.hidden(spark, path)
    states = {str(r.chunk): r.state for r in layout.catalogue(spark, path).collect()}
    assert set(states.values()) == {"compacted", "raw"} and all((c <= "2024-01-23") == (s == "compacted") for c, s in states.items())


def test_only_changed_chunks_are_compacted_again(spark, flights):
    path = scratch_path(spark, "shared")
    assert layout.catalogue(spark, path).count() == 0 and layout.compact_chunks(spark, path, "flights", AS_OF) == []
    sinks.append(flights, path, "flights")
    due = layout.compact_chunks(spark, path, "flights", AS_OF, at_once=5)
    assert due and layout.compact_chunks(spark, path, "flights", AS_OF) == []
    late = flights.where(F.to_date("timestamp") == due[2]).limit(1)
    assert sinks.append(late, path, "flights", writer="late", batch=1) == 1
    assert [(str(r.chunk), r.state) for r in layout.catalogue(spark, path).where("state = 'dirty'").collect()] == [(due[2], "dirty")]
    assert layout.compact_chunks(spark, path, "flights", AS_OF) == [due[2]]
    assert sinks.read_table(spark, path, "flights").count() == flights.count() + 1


def test_a_job_run_again_under_its_name_adds_nothing(spark, flights):
    path, metrics = scratch_path(spark, "shared"), scratch_path(spark, "metrics")
    n = flights.count()
    assert [sinks.append(flights, path, "flights", metrics_path=metrics, writer="job", batch=b) for b in (1, 1, 2)] == [n, 0, n]
    assert sinks.read_table(spark, path, "flights").count() == 2 * n
    assert sorted(r.rows for r in spark.read.parquet(metrics).collect()) == [n, n]
    assert sinks.append(flights.where("false"), path, "flights", writer="job", batch=3) == 0
