"""A small hand-written log whose features are worked out by hand."""

from __future__ import annotations

from datetime import datetime, timezone

from ebbwatch.sources.activity_log import RAW_SCHEMA

GOLDEN_PAGES = ["Cancel", "CancellationConfirmation", "Home", "NextSong"]


def ms(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def event(**values):
    row = dict.fromkeys(RAW_SCHEMA.fieldNames())
    row.update(values)
    return tuple(row[name] for name in RAW_SCHEMA.fieldNames())


def log(spark, events):
    return spark.createDataFrame([event(**e) for e in events], RAW_SCHEMA)


def _e(user, time, session, item, page, auth, level, length, location, gender):
    return dict(
        userId=user, ts=ms(time), sessionId=session, itemInSession=item, page=page, auth=auth, level=level,
        length=length, location=location, gender=gender, registration=ms("2018-09-01 00:00:00"),
    )


GOLDEN = [
    _e("1", "2018-10-01 23:50:00", 10, 0, "Home", "Logged In", "free", None, "Albany, NY", "F"),
    _e("1", "2018-10-01 23:58:00", 10, 1, "NextSong", "Logged In", "free", 200.0, "Albany, NY", "F"),
    _e("1", "2018-10-02 00:10:00", 10, 2, "NextSong", "Logged In", "free", 100.0, "Albany, NY", "F"),
    _e("1", "2018-10-02 12:00:00", 11, 0, "Home", "Logged In", "paid", None, "Albany, NY", "F"),
    _e("1", "2018-11-01 09:00:00", 12, 0, "Cancel", "Logged In", "paid", None, "Albany, NY", "F"),
    _e("1", "2018-11-01 09:00:30", 12, 1, "Cancellation Confirmation", "Cancelled", "paid", None, "Albany, NY", "F"),
    _e("2", "2018-10-05 08:00:00", 20, 0, "Home", "Logged In", "free", None, "Nowhere", "M"),
    _e("2", "2018-10-05 08:01:00", 20, 1, "Home", "Logged In", "free", None, "Nowhere", "M"),
    _e("", "2018-10-05 09:00:00", 21, 0, "Home", "Logged Out", "free", None, None, None),
    _e("2", "2018-10-06 09:00:00", 22, 0, "Logout", "Logged Out", "free", None, "Nowhere", "M"),
]
