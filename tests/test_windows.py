import datetime as dt
import random

import checks
import pytest
from pyspark.sql import functions as F

from stormglass.operators import windows

DAY0 = dt.date(2019, 12, 20)


def days(offsets):
    return [DAY0 + dt.timedelta(days=o) for o in offsets]


@pytest.fixture
def monkeypatch_conf(spark):
    before = {}

    def put(key, value):
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("bin_days", [None, 1, 4, 30])
@pytest.mark.parametrize("broadcast_bytes", [windows.BROADCAST_BYTES, 0])
def test_window_join_is_the_range_join(spark, monkeypatch_conf, broadcast_bytes, bin_days):
    draw = random.Random(1)
    facts = [(i, d) for i, d in enumerate(days(draw.choices(range(60), k=200)))]
    facts += [(1000 + i, DAY0) for i in range(100)]  # a hot day
    events = [(i, d) for i, d in enumerate(days(draw.choices(range(60), k=15)))]
    if not broadcast_bytes:
        monkeypatch_conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = windows.event_window_join(
        spark.createDataFrame(facts, "f int, day date"),
        "day", spark.createDataFrame(events, "e int, event_day date"), "event_day", -3, 5,
        broadcast_bytes=broadcast_bytes, bin_days=bin_days,
    )
    found = {(r["f"], r["e"], r["days_from_spike"]) for r in joined.collect()}
    wanted = {
        (f, e, (a - b).days) for f, a in facts for e, b in events if -3 <= (a - b).days <= 5
    }
    assert found == wanted
    text = checks.plan(joined)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert ("BroadcastHashJoin" in text) == (broadcast_bytes > 0)


def test_a_wide_window_lists_an_event_a_few_times(spark):
    """61 days: an event is listed 3 times (61 times in bins of a day), and all pairs are found, by month too."""
    facts = spark.createDataFrame([(i, d) for i, d in enumerate(days(range(-100, 300)))], "f int, day date").withColumn(
        "month", F.date_format("day", "yyyy-MM"))
    events = spark.createDataFrame([(d,) for d in days(range(0, 200, 3))], "event_day date")
    rows = {}
    for name, options in {"bins": {}, "days": {"bin_days": 1}, "months": {"fact_month": "month"}}.items():
        joined = windows.event_window_join(facts, "day", events, "event_day", -30, 30, **options)
        found = joined.select("f", "event_day", "days_from_spike").collect()
        rows[name] = checks.normal(found)
        assert len(found) == 67 * 61 and "BroadcastHashJoin" in checks.plan(joined)
    assert rows["bins"] == rows["days"] == rows["months"]
    listed = {width: windows.listed_by_bin(events, "event_day", -30, 30, width).count() for width in (30, 1)}
    assert listed[1] == 67 * 61 and listed[30] <= 67 * 3
    assert windows.listed_by_bin(events, "event_day", -30, 30, 30, by_month=True).count() <= 67 * 6


def test_hot_date_is_split_in_the_shuffled_join(spark, tmp_path):
    facts = spark.range(60_000).selectExpr(
        "id", "date_add(date'2019-12-20', if(id % 3 = 0, 5, cast(id % 40 as int))) AS day",
        "sha2(cast(id as string), 256) AS text",
    )
    facts.write.parquet(str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    events = spark.createDataFrame([(d,) for d in days(range(0, 40, 2))], "event_day date")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        joined = windows.event_window_join(
            stored, "day", events, "event_day", -1, 1, broadcast_bytes=0
        )
        grouped = joined.groupBy("event_day").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
        found = checks.normal(grouped.collect())
        assert "skew=true" in checks.plan(grouped)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    direct = windows.event_window_join(stored, "day", events, "event_day", -1, 1)
    wanted = direct.groupBy("event_day").agg(F.count("*").alias("n"), F.sum("id").alias("s"))
    assert found == checks.normal(wanted.collect())


def test_window_join_without_events(spark):
    facts = spark.createDataFrame([(1, DAY0)], "f int, day date")
    none = spark.createDataFrame([], "event_day date")
    assert windows.event_window_join(facts, "day", none, "event_day", -3, 3).count() == 0


def test_window_join_range_reaches_the_scan(spark, tmp_path):
    facts = spark.createDataFrame([(i, d) for i, d in enumerate(days(range(50)))], "f int, day date")
    facts.write.parquet(str(tmp_path / "flat"))
    facts.write.partitionBy("day").parquet(str(tmp_path / "by_day"))
    events = spark.createDataFrame([(d,) for d in days([10, 30])], "event_day date")
    flat = windows.event_window_join(
        spark.read.parquet(str(tmp_path / "flat")), "day", events, "event_day", -1, 1
    )
    assert "GreaterThanOrEqual(day,2019-12-29)" in checks.plan(flat)
    by_day = windows.event_window_join(
        spark.read.parquet(str(tmp_path / "by_day")), "day", events, "event_day", -1, 1
    )
    assert "dynamicpruning" in checks.plan(by_day)
    assert flat.count() == by_day.count() == 6


@pytest.mark.parametrize("buckets", [None, 3])
def test_top_per_group(spark, buckets):
    draw = random.Random(2)
    rows = [("hot" if draw.random() < 0.6 else draw.choice("abc"), draw.randrange(500)) for _ in range(900)]
    frame = spark.createDataFrame(rows, "g string, v int").repartition(5)
    top = windows.top_per_group(frame, ["g"], [F.col("v").asc()], 7, buckets)
    found = sorted(tuple(r) for r in top.collect())
    wanted = sorted(
        (g, v) for g in {g for g, _ in rows} for v in sorted(v for h, v in rows if h == g)[:7]
    )
    assert found == wanted
    assert "WindowGroupLimit" in checks.plan(top)


def _exchange_records(frame):
    """Records that each exchange of a finished plan wrote, and the most that a reducer read of it."""
    found, todo = [], [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_top_of_a_hot_group_shuffles_n_rows_a_task(spark, tmp_path):
    tasks, n, buckets = 8, 10, 4
    rows = spark.range(0, 40_000, 1, tasks).selectExpr("if(id % 10 = 0, id % 3, 9) AS g", "hash(id) AS v")
    top = windows.top_per_group(rows, ["g"], [F.col("v").asc()], n, buckets)
    top.collect()
    last, first = _exchange_records(top)
    groups = 4
    assert first <= tasks * groups * n
    assert last <= buckets * groups * n


def test_nearest_date(spark):
    draw = random.Random(3)
    available = set(days(draw.sample(range(-900, 2500), 25)))
    wanted = set(days(draw.sample(range(-1200, 3500), 300))) | set(list(available)[:5])
    result = windows.nearest_date(
        spark.createDataFrame([(d,) for d in wanted], "date date"),
        spark.createDataFrame([(d,) for d in available] * 2, "date date"),
    )
    found = {r["date"]: r["nearest_date"] for r in result.collect()}
    assert found == {
        d: min(sorted(available), key=lambda a, d=d: abs((a - d).days)) for d in wanted
    }
    assert "NestedLoop" not in checks.plan(result)


def test_nearest_of_nothing_is_null(spark):
    wanted = spark.createDataFrame([(DAY0,)], "date date")
    none = spark.createDataFrame([], "date date")
    assert windows.nearest_date(wanted, none).collect()[0]["nearest_date"] is None


def test_previous_row_crosses_years(spark):
    dates = days([0, 3, 20, 21, 800, 801])
    frame = spark.createDataFrame([(d, float(i)) for i, d in enumerate(dates)], "date date, v double")
    rows = windows.previous_row(frame).orderBy("date").collect()
    assert [r["_previous"]["v"] if r["_previous"] else None for r in rows] == [None, 0, 1, 2, 3, 4]


def test_measure(spark):
    frame = spark.createDataFrame([("abcd", DAY0), (None, DAY0)], "s string, d date")
    extent = windows.measure(frame, "d")
    assert extent == windows.Extent(2 * 16 * 3 + 4, DAY0, DAY0)
