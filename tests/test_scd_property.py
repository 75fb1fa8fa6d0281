"""Randomised SCD2 batches against a brute-force model (Hypothesis, small fixtures)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakehand.operators import scd as S

BK, SK = "K_BK", "K_SK"
VALUES = st.sampled_from([None, "", "a", "b"])
BATCH = st.dictionaries(st.sampled_from(["1", "2", "3", "4"]), VALUES, min_size=1, max_size=4)


def model(batches):
    """Brute force: rows as (key, value, created, ended, current)."""
    rows = []
    for i, b in enumerate(batches):
        start = dt.datetime(2024, 1, 1 + i)
        if i == 0:
            rows = [[k, v, start, None, 1] for k, v in b.items()]
            continue
        for k, v in sorted(b.items()):
            cur = [r for r in rows if r[0] == k and r[4] == 1]
            if cur:
                if cur[0][1] != v:
                    cur[0][3], cur[0][4] = start - dt.timedelta(seconds=1), 0
                    rows.append([k, v, start, None, 1])
            elif not any(r[0] == k for r in rows):
                rows.append([k, v, start, None, 1])
    return sorted(((r[0], r[1], r[2], r[3], r[4]) for r in rows), key=_key)


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(BATCH, min_size=1, max_size=3))
def test_scd2_matches_model(spark, batches):
    t = None
    for i, b in enumerate(batches):
        src = spark.createDataFrame(sorted(b.items()), f"{BK} string, v string")
        start = f"2024-01-0{1 + i} 00:00:00"
        t = S.scd2_first_load(src, BK, SK, start) if t is None else S.scd2_apply(t, src, BK, SK, start)
    got = sorted(((r[BK], r.v, r._Created, r._Ended, r._Current) for r in t.collect()), key=_key)
    assert got == model(batches)
