"""Archive catalogue over {feed}_{yyyymmdd}.zip files; a later fetch of the
same day replaces the earlier one."""

import datetime as dt
import os
import time

from movelake.session import scratch_path
from movelake.sources.archives import archive_catalogue


def test_catalogue_latest_per_feed_day(spark):
    root = scratch_path(spark, "archives")
    os.makedirs(f"{root}/round1")
    os.makedirs(f"{root}/round2")
    for name, size in [("vbb_20260419.zip", 10), ("vbb_20260420.zip", 20), ("hvv_20260419.zip", 30)]:
        with open(f"{root}/round1/{name}", "wb") as f:
            f.write(b"x" * size)
    time.sleep(1.1)
    with open(f"{root}/round2/vbb_20260419.zip", "wb") as f:   # second fetch of the same day
        f.write(b"y" * 55)
    with open(f"{root}/round2/notes.txt", "w") as f:
        f.write("not an archive")
    rows = {(r.feed, r.day): r for r in archive_catalogue(spark, root).collect()}
    assert set(rows) == {("vbb", dt.date(2026, 4, 19)), ("vbb", dt.date(2026, 4, 20)),
                         ("hvv", dt.date(2026, 4, 19))}
    latest = rows[("vbb", dt.date(2026, 4, 19))]
    assert latest.bytes == 55 and "round2" in latest.path and latest.fetches == 2
