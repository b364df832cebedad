import datetime as dt
import math
import random
from collections import Counter, defaultdict

import checks
import pytest
from pyspark.sql import functions as F

from stormglass import schemas
from stormglass.functions import measures
from stormglass.operators import cleaning, portfolio, tension
from stormglass.plans import jobs
from stormglass.sources import news as news_source

CLEAN = "date date, neg_score double, category string"


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def index_frame(spark, values, start=0):
    rows = [(day(start + i), float(v), 1, "CONFLICT") for i, v in enumerate(values)]
    return spark.createDataFrame(
        rows, "date date, geo_tension_index double, total_events bigint, dominant_category string"
    )


def test_cleaning_drops_what_cannot_be_scored(spark):
    rows = [
        ("ok", "20200101120000", "s", "u", "WAR#RS#", "0,1,5.5,0", "CONFLICT"),
        ("short date", "2020", "s", "u", "WAR#RS#", "0,1,5.5,0", "CONFLICT"),
        ("bad tone", "20200101", "s", "u", "WAR#RS#", "bad", "CONFLICT"),
        ("no third tone", "20200101", "s", "u", "WAR#RS#", "1,2", "CONFLICT"),
        ("tone too high", "20200101", "s", "u", "WAR#RS#", "0,1,50.01,0", "CONFLICT"),
        ("tone at the limits", "20200102", "s", "u", "WAR#RS#", "0,1,50,0", "CONFLICT"),
        ("domestic", "20200101", "s", "u", "WAR#US#", "0,1,5.5,0", "CONFLICT"),
        ("no themes", "20200101", "s", "u", None, "0,1,5.5,0", "CONFLICT"),
    ]
    clean = cleaning.clean_news(spark.createDataFrame(rows, schemas.FILTERED_NEWS))
    assert {r["record_id"] for r in clean.collect()} == {"ok", "tone at the limits"}
    stored = news_source.store_as_clean(
        news_source.as_store_rows(spark.createDataFrame(rows, schemas.FILTERED_NEWS))
    )
    columns = ["date", "neg_score", "category"]
    assert checks.normal(stored.select(columns).collect()) == checks.normal(
        clean.select(columns).collect()
    )


def test_profile_equals_brute_force_with_a_hot_day(spark):
    draw = random.Random(4)
    rows = [
        (day(0 if draw.random() < 0.4 else draw.randrange(40)), draw.randrange(5000) / 100,
         draw.choice(["A", "B", "C"])) for _ in range(3000)
    ]
    profile = tension.daily_profile(spark.createDataFrame(rows, CLEAN).repartition(6))
    by_day = defaultdict(list)
    for d, score, category in rows:
        by_day[d].append((score, category))
    found = {r["date"]: r for r in profile.collect()}
    assert set(found) == set(by_day)
    for d, items in by_day.items():
        mean = sum(s for s, _ in items) / len(items)
        counts = Counter(c for _, c in items)
        assert found[d]["total_events"] == len(items)
        assert found[d]["avg_negative_tone"] == pytest.approx(mean)
        assert found[d]["geo_tension_raw"] == pytest.approx(mean * math.log(len(items) + 1))
        assert found[d]["dominant_category"] == min(counts, key=lambda c: (-counts[c], c))


def test_ties_give_one_row_unless_asked_for(spark):
    counts = spark.createDataFrame(
        [(day(0), "B", 2), (day(0), "A", 2), (day(0), "C", 1)],
        "date date, category string, cat_count bigint",
    )
    one = tension.dominant_category(counts).collect()
    assert [r["dominant_category"] for r in one] == ["A"]
    both = tension.dominant_category(counts, keep_ties=True).collect()
    assert {r["dominant_category"] for r in both} == {"A", "B"}


def test_index_is_between_0_and_10_and_null_without_spread(spark):
    frame = spark.createDataFrame([(day(i), float(i)) for i in range(500)],
                                  "date date, geo_tension_raw double")
    low, high = tension.index_percentiles(frame).first()
    assert (low, high) == (pytest.approx(4.99), pytest.approx(494.01))
    scaled = tension.normalize_index(frame, tension.index_percentiles(frame))
    values = [r["geo_tension_index"] for r in scaled.collect()]
    assert min(values) == 0 and max(values) == 10
    flat = frame.withColumn("geo_tension_raw", F.lit(3.0))
    flat_index = tension.normalize_index(flat, tension.index_percentiles(flat))
    assert flat_index.filter("geo_tension_index IS NOT NULL").count() == 0


def test_spikes_per_year(spark):
    quiet = [1.0, 1.1] * 30
    frame = index_frame(spark, [*quiet, 9.0]).unionByName(index_frame(spark, [10.0], start=400))
    spikes = tension.spike_events(frame).collect()
    assert [r["date"] for r in spikes] == [day(60)]  # a year of one day has no deviation
    assert spikes[0]["is_spike"] is True
    assert spikes[0].asDict().keys() == set(tension.SPIKE_COLUMNS)


def test_uniform_days_have_no_spike(spark):
    assert tension.spike_events(index_frame(spark, [i % 10 for i in range(300)])).count() == 0


def test_job_reads_the_news_once_and_prunes_columns(spark, tmp_path):
    rows = [
        (str(i), f"202001{1 + i % 28:02d}120000", "s", "u", "WAR#RS#", f"0,1,{i % 40}.5,0", "CONFLICT")
        for i in range(200)
    ]
    path = str(tmp_path / "store")
    news_source.write_news_store(spark.createDataFrame(rows, schemas.FILTERED_NEWS), path)
    store = news_source.scan_news_store(spark, path)
    clean = news_source.store_as_clean(store)
    text = checks.plan(tension.daily_profile(clean))
    assert "ReadSchema: struct<category:string,neg_score:double,is_foreign:boolean>" in text
    index = jobs.tension_index(clean)
    assert all("/daily_profile/" in f for f in index.daily.inputFiles())
    assert index.daily.count() == 28


def test_global_thresholds_and_levels(spark):
    frame = index_frame(spark, [1.0] * 50 + [3.0] * 2 + [9.0])
    levels = portfolio.with_risk_level(frame, portfolio.global_risk_stats(frame))
    by_day = {r["date"]: r["risk_level"] for r in levels.collect()}
    assert by_day[day(0)] == "Low" and by_day[day(52)] == "High"


def test_latest_reading(spark):
    one = portfolio.latest_reading(index_frame(spark, [2.0])).first()
    assert (one["current_score"], one["delta_score"], one["events_today"]) == (2.0, None, 1)
    two = portfolio.latest_reading(index_frame(spark, [2.0, 5.0, 4.5])).first()
    assert (two["date"], two["current_score"], two["delta_score"]) == (day(2), 4.5, -0.5)


def test_recent_slice_is_relative_to_a_given_time(spark):
    frame = index_frame(spark, range(10))
    recent = cleaning.recent_slice(frame, F.lit("2020-01-10 12:00:00"), 5)
    assert {r["date"] for r in recent.collect()} == {day(i) for i in range(5, 10)}


def test_bar_width(spark):
    frame = spark.createDataFrame([(-2.0, 4.0), (1.0, 0.0), (None, 4.0)], "v double, m double")
    widths = frame.select(measures.bar_width(F.col("v"), F.col("m")).alias("w")).collect()
    assert [r["w"] for r in widths] == [90, 0, 0]
