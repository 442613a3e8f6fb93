"""The binned range join against a plain loop."""

import datetime as dt
import random

from bundleflow.operators import ranges

D0 = dt.date(2020, 1, 1)


def test_range_join_equals_a_loop(spark, monkeypatch):
    r = random.Random(4)
    points = [(r.choice("aab") if r.random() < 0.95 else None, D0 + dt.timedelta(r.randrange(400)), i) for i in range(600)]
    points += [("a", None, 9000), ("zz", D0, 9001)]
    periods = []
    for k in "abc":
        for p in range(8):
            since = D0 + dt.timedelta(r.randrange(-60, 380))
            until = None if r.random() < 0.3 else since + dt.timedelta(r.choice((-1, 0, 1, 31, 32, 33, 200)))
            periods.append((k, since, until, f"{k}{p}"))
    want = []
    for k, d, i in points:
        found = [v for pk, s, u, v in periods if d and pk == k and s <= d and (u is None or d <= u)]
        want += [(i, v) for v in found] or [(i, None)]
    p = spark.createDataFrame(points, "k string, day date, i int").repartition(3)
    q = spark.createDataFrame(periods, "k string, since date, until date, v string")
    for days in (1, 7, 32, 1000):
        monkeypatch.setattr(ranges, "BIN_DAYS", days)
        got = [(r.i, r.v) for r in ranges.range_join(p, q, ["k"], "day", "since", "until", ["v"]).collect()]
        assert sorted(map(str, got)) == sorted(map(str, want))
    assert ranges.range_join(p, q.limit(0), ["k"], "day", "since", "until", ["v"]).count() == len(points)
    assert ranges.range_join(p.limit(0), q, ["k"], "day", "since", "until", ["v"]).count() == 0


def test_keys_are_dealt_by_bin(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = spark.range(10).selectExpr("if(id % 2 = 0, 'a', 'b') AS k", "date_add(date'2020-01-01', cast(id * 40 as int)) AS day")
        q = spark.range(40).selectExpr("if(id % 2 = 0, 'a', 'b') AS k", "date_add(date'2020-01-01', cast(id * 10 as int)) AS since",
                                       "date_add(date'2020-01-09', cast(id * 10 as int)) AS until", "id AS v")
        ranges.small_side, kept = (lambda df: df), ranges.small_side
        try:
            plan = ranges.range_join(p, q, ["k"], "day", "since", "until", ["v"])._jdf.queryExecution().executedPlan().toString()
        finally:
            ranges.small_side = kept
        assert "point bin" in plan and "Exchange hashpartitioning(k" in plan and "NestedLoop" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
