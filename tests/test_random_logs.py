"""Features of random logs, with nulls and ties, against a plain reading of their definitions."""

import random
from collections import defaultdict
from datetime import datetime, timezone
from statistics import mean

import pytest
from tests.log_fixture import log, ms

from ebbwatch.operators.clean import clean_activity
from ebbwatch.plans.features import user_features

PAGES = ["Cancel", "Home", "NextSong", "ThumbsUp"]


def random_events(seed, n=300):
    rng = random.Random(seed)
    start = ms("2023-12-20")
    return [
        dict(
            userId=rng.choice(["1", "2", "3", "4", "", None, "x7"]),
            ts=start + rng.randrange(0, 40 * 86_400_000, 3_600_000),
            sessionId=rng.choice([None, *range(12)]),
            itemInSession=rng.choice([None, *range(30)]),
            page=rng.choice([None, "Home", "Home", "NextSong", "Thumbs Up", "Cancel" if rng.random() < 0.05 else "Home"]),
            auth=rng.choice(["Logged In"] * 8 + ["Logged Out", None, "Cancelled" if rng.random() < 0.02 else "Logged In"]),
            level=rng.choice(["free", "paid"]),
            gender="F",
            location=rng.choice(["Albany, NY", "Albany, NY", "Reno, NV"]),
            registration=rng.choice([ms("2023-12-01"), ms("2023-12-01"), ms("2023-11-15")]),
        )
        for _ in range(n)
    ]


def mean_or_none(values):
    known = [v for v in values if v is not None]
    return mean(known) if known else None


def max_or_none(values):
    known = [v for v in values if v is not None]
    return max(known) if known else None


def expected(events):
    users = defaultdict(list)
    for e in events:
        if e["auth"] in (None, "Logged Out") or e["userId"] in ("", None, "x7"):
            continue
        day = datetime.fromtimestamp(e["ts"] / 1000, timezone.utc).date()
        users[int(e["userId"])].append(dict(e, daily=day, monthly=day.month, page=(e["page"] or "").replace(" ", "") or None))
    for user, rows in users.items():
        last = max(r["ts"] for r in rows)
        out = {
            "userId": user,
            "last_interaction": last,
            "label": int(any(r["page"] == "Cancel" or r["auth"] == "Cancelled" for r in rows)),
            "valid_level": max((r["ts"], -1 if r["itemInSession"] is None else r["itemInSession"], r["level"]) for r in rows)[2],
        }
        for grain in ("daily", "monthly"):
            periods = defaultdict(list)
            for r in rows:
                periods[r[grain]].append(r)
            durations, items, sessions, visits = [], [], [], defaultdict(list)
            for within in periods.values():
                by_session = defaultdict(list)
                for r in within:
                    by_session[r["sessionId"]].append(r["ts"])
                durations.append(mean((max(t) - min(t)) * 0.001 for t in by_session.values()))
                sessions.append(len([s for s in by_session if s is not None]))
                items.append(max_or_none(r["itemInSession"] for r in within))
                for page in PAGES[1:]:
                    n = sum(r["page"] == page for r in within)
                    if n:
                        visits[page].append(n)
            out[f"avg_{grain}_session_duration"] = mean(durations)
            out[f"avg_{grain}_items"] = mean_or_none(items)
            out[f"avg_{grain}_sessions"] = mean(sessions)
            out |= {f"avg_{grain}_{p}": mean(visits[p]) if visits[p] else 0.0 for p in PAGES[1:]}
        bases = {(r["location"][-2:], int((last - r["registration"]) / 86_400_000)) for r in rows}
        for location, days in bases:
            yield {**out, "gender": "F", "location": location, "registered_days": days}


@pytest.mark.parametrize("seed", range(4))
def test_features_of_a_random_log(spark, seed):
    events = random_events(seed)
    found = user_features(clean_activity(log(spark, events)), PAGES).collect()
    key = lambda row: (row["userId"], row["location"], row["registered_days"])
    found = sorted((r.asDict() for r in found), key=key)
    wanted = sorted(expected(events), key=key)
    assert [key(r) for r in found] == [key(r) for r in wanted]
    for ours, plain in zip(found, wanted):
        assert ours == pytest.approx(plain)
