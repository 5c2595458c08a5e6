"""First-wins de-dup of ship pings (DED-1) on generated pings: the expected
survivors are worked out from the key, not written down row by row."""

import datetime as dt
import random

import pytest

from movelake.operators.dedup import dedup_pings

START = dt.datetime(2031, 5, 17, 23, 59, 57, tzinfo=dt.timezone.utc)
CELL = 1e-5  # degrees
SCHEMA = "seq long, mmsi string, latitude double, longitude double, timestamp timestamp"


def survivors(spark, rows):
    """Sequence numbers kept of rows (ship, latitude, longitude, seconds after START)."""
    data = [(i, ship, lat, lon, START + dt.timedelta(seconds=s)) for i, (ship, lat, lon, s) in enumerate(rows)]
    return [r.seq for r in dedup_pings(spark.createDataFrame(data, SCHEMA)).orderBy("seq").collect()]


def test_shuffled_copies_keep_the_lowest_sequence(spark):
    rng = random.Random(20)
    cells = [(f"ship{i % 7}", (i - 15) * 11 * CELL, (15 - i) * 13 * CELL, i % 5) for i in range(30)]
    rows = [c for c in cells for _ in range(rng.randrange(1, 6))]
    rng.shuffle(rows)
    first = sorted({c: rows.index(c) for c in rows}.values())
    assert survivors(spark, rows) == first and len(first) == len(cells)


@pytest.mark.parametrize("lat, lon", [(-33.86123, -70.66456), (0.0, 0.0), (71.25, -179.99999), (-0.00003, 179.99999)])
def test_cell_reaches_less_than_half_a_step(spark, lat, lon):
    near, far = 0.4 * CELL, 0.6 * CELL
    rows = [("s", lat, lon, 0), ("s", lat + near, lon, 0), ("s", lat, lon - near, 0),
            ("s", lat + far, lon, 0), ("s", lat, lon - far, 0)]
    assert survivors(spark, rows) == [0, 3, 4]


def test_antimeridian_sides_are_two_places(spark):
    assert survivors(spark, [("s", 12.5, 180.0, 0), ("s", 12.5, -180.0, 0)]) == [0, 1]


def test_whole_seconds_across_midnight(spark):
    rows = [("s", 1.0, 2.0, s / 4) for s in range(24)]
    assert survivors(spark, rows) == list(range(0, 24, 4))


def test_missing_values_are_one_key_each(spark):
    rows = [(ship, lat, lon, 0) for ship in ("s", None) for lat in (1.0, None) for lon in (2.0, None)]
    assert survivors(spark, rows + rows) == list(range(len(rows)))


def test_first_row_is_kept_whole(spark):
    out = dedup_pings(spark.createDataFrame([(7, "s", 3.0 + 0.3 * CELL, 4.0, START), (5, "s", 3.0, 4.0 - 0.3 * CELL, START)], SCHEMA)).collect()
    assert [(r.seq, r.latitude, r.longitude) for r in out] == [(5, 3.0, 4.0 - 0.3 * CELL)]
