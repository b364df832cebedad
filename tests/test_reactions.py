import datetime as dt
import random
from collections import defaultdict

import checks
import pytest
from pyspark.sql import functions as F

from stormglass.operators import archive, portfolio, reactions
from stormglass.plans import jobs
from stormglass.sources import tables

SPIKE = "date date, geo_tension_index double, dominant_category string"
PRICE = "date date, ticker string, close double"


def day(n):
    return dt.date(2021, 3, 1) + dt.timedelta(days=n)


def cells(spark, prices, spikes):
    return reactions.reaction_cells(reactions.window_prices(
        spark.createDataFrame(prices, PRICE),
        spark.createDataFrame([(d, 9.0, "CONFLICT") for d in spikes], SPIKE),
    ))


def brute(prices, spikes):
    result = defaultdict(list)
    for s in spikes:
        for d, t, c in prices:
            for d0, t0, base in prices:
                if t0 == t and d0 == s and abs((d - s).days) <= 30:
                    value = (c - base) / base * 100 if base else None
                    result[s, t, (d - s).days].append(value)
    return result


@pytest.mark.parametrize("copies", [1, 3])
def test_cells_equal_all_pairs(spark, copies):
    draw = random.Random(copies)
    prices = [
        (day(n), t, float(draw.randrange(1, 400)))
        for n in range(0, 90) for t in ("AA", "B.K") if n % 7 < 5
        for _ in range(draw.randrange(1, copies + 1))
    ]
    prices += [(day(35), "ZERO", 0.0), (day(36), "ZERO", 2.0)]
    spikes = [day(35), day(37), day(40)]  # day 40 has no price
    wanted = brute(prices, spikes)
    found = {
        (r["spike_date"], r["ticker"], r["days_from_spike"]): r
        for r in cells(spark, prices, spikes).collect()
    }
    assert set(found) == set(wanted)
    for key, values in wanted.items():
        real = [v for v in values if v is not None]
        assert found[key]["num_obs"] == len(values)
        assert found[key]["valid_obs"] == len(real)
        if real:
            assert found[key]["avg_return_pct"] == pytest.approx(sum(real) / len(real), abs=1e-9)
            assert found[key]["min_return_pct"] == pytest.approx(min(real), abs=1e-9)
        else:
            assert found[key]["avg_return_pct"] is None


def test_summary_and_curve(spark):
    prices = [(day(n), "AA", 100.0 + n) for n in range(0, 80) if n % 7 < 5]
    spikes = [day(30), day(37)]
    result = cells(spark, prices, spikes)
    wanted = brute(prices, spikes)
    summary = reactions.ticker_summary(result).first()
    at_5 = [v for (s, t, k), vs in wanted.items() if k == 5 for v in vs]
    assert summary["avg_return_5d"] == (pytest.approx(sum(at_5) / len(at_5)) if at_5 else None)
    assert summary["num_events"] == sum(len(v) for v in wanted.values())
    assert summary["worst_drawdown"] == pytest.approx(min(v for vs in wanted.values() for v in vs))
    curve = {r["days_from_spike"]: r for r in reactions.reaction_curve(result).collect()}
    assert curve[0]["avg_return_pct"] == 0 and curve[0]["num_events"] == 2
    rows = reactions.join_day0_base(reactions.window_prices(
        spark.createDataFrame(prices, PRICE),
        spark.createDataFrame([(d, 9.0, "CONFLICT") for d in spikes], SPIKE),
    ))
    assert rows.count() == summary["num_events"]


def test_wide_prices(spark, tmp_path):
    nanos = [int(dt.datetime(2016 + y, 1, 4, tzinfo=dt.UTC).timestamp()) * 10**9 for y in range(2)]
    first = spark.createDataFrame([(nanos[0], 1.5, float("nan"))], "Date bigint, `BRK.B` double, X double")
    second = spark.createDataFrame([(nanos[1], 2.5, None, 9.0)],
                                   "Date bigint, `BRK.B` double, X double, NEW double")
    first.write.parquet(str(tmp_path / "2016"))
    second.write.parquet(str(tmp_path / "2017"))
    long = tables.scan_long_prices(spark, str(tmp_path / "2016"), str(tmp_path / "2017"))
    assert checks.normal(long.collect()) == checks.normal([
        ("2016-01-04", "BRK.B", 1.5), ("2017-01-04", "BRK.B", 2.5), ("2017-01-04", "NEW", 9.0),
    ])


def test_portfolio(spark):
    summary = spark.createDataFrame(
        [("AAPL", 2.0, None, -10.0, 5), ("XOM", -1.0, 3.0, -20.0, 5)],
        "ticker string, avg_return_5d double, avg_return_30d double, worst_drawdown double, num_events bigint",
    )
    joined = portfolio.join_portfolio_reactions(tables.literal_portfolio(spark), summary)
    risk = portfolio.portfolio_risk(joined).first()
    assert tuple(risk) == pytest.approx((0.1, 1.5, -13.0))
    ranked = portfolio.exposure_ranking(joined).collect()
    assert [(r["ticker"], r["exposure_score"]) for r in ranked] == [
        ("XOM", 10.0), ("AAPL", 3.0), ("LMT", None)
    ]
    assert portfolio.most_exposed(joined).first()["ticker"] == "XOM"
    zero = portfolio.join_portfolio_reactions(tables.literal_portfolio(spark), summary, True)
    assert zero.filter("ticker = 'LMT'").first()["worst_drawdown"] == 0
    assert portfolio.weight_check(tables.literal_portfolio(spark)).first()["is_complete"]


@pytest.mark.parametrize(("offsets", "wanted"), [
    ([1, 4, 6, 9], 4), ([5, 4], 5), ([7, 9], 7), ([1, 2], 2), ([-5, 0], None), ([8, 2], 2),
])
def test_target_offset(spark, offsets, wanted):
    rows = spark.createDataFrame([(day(0), k) for k in offsets], "spike_date date, days_from_spike int")
    found = [r["target_offset"] for r in archive.target_offset(rows).collect()]
    assert found == ([] if wanted is None else [wanted])


def test_sector_impact_uses_the_nearest_date(spark):
    reactions_by_spike = spark.createDataFrame(
        [(day(0), "XOM", 4, 2.0), (day(0), "CVX", 4, 4.0), (day(0), "ZZZ", 5, 9.0), (day(0), "XOM", -5, 7.0)],
        "spike_date date, ticker string, days_from_spike int, avg_return_pct double",
    )
    wanted = spark.createDataFrame([(day(2),)], "date date")
    rows = archive.sector_impact(wanted, reactions_by_spike, tables.sector_tickers(spark)).collect()
    assert [tuple(r) for r in rows] == [(day(2), day(0), 4, "Energy", 3.0)]


def test_intraday(spark):
    rows = [("A", "2024-01-01 09:30:00", 10.0, 1), ("A", "2024-01-01 09:31:00", 12.0, 3),
            ("A", "2024-01-01 09:31:00", 99.0, 2), ("B", "2024-01-01 09:30:00", 5.0, 1)]
    frame = spark.createDataFrame(rows, "etf string, t string, close double, n bigint").withColumn(
        "t", F.to_timestamp("t"))
    found = archive.intraday_return(frame, "etf", "t", "close", tie="n")
    assert {r["etf"]: r["return_pct"] for r in found.collect()} == {"A": 20.0, "B": 0.0}
    assert "SortAggregate" not in checks.plan(found)


def news(spark, rows):
    return spark.createDataFrame(
        rows, "article_date date, domain string, url string, themes string, category string"
    )


def test_spike_news_takes_n_in_order_and_makes_titles_after_the_join(spark):
    url = "https://x.example/military-strike-number-{}.html"
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(day(k), "d", url.format(c * 4), "t", "c") for k in range(-5, 6) for c in letters]
    rows += [(day(0), "d", "https://x.example/short.html", "t", "c")]
    spikes = spark.createDataFrame([(day(0), 9.0, "CONFLICT")], SPIKE)
    found = jobs.spike_news(news(spark, rows), spikes, n=30)
    got = [(r["days_from_spike"], r["url"]) for r in found.collect()]
    wanted = [(k, url.format(c * 4)) for k in range(-3, 4) for c in letters][:30]
    assert sorted(got) == wanted
    text = checks.optimized(found)
    assert text.index("Generate explode(filter") < text.index("Join Inner")
    assert "Python" not in checks.plan(found)
    closest = jobs.spike_news(news(spark, rows), spikes, n=26, closest_first=True).collect()
    assert {r["days_from_spike"] for r in closest} == {0}


def test_labels(spark):
    spikes = spark.createDataFrame([(day(0), 9.0, "C"), (day(50), 8.0, "C"), (day(90), 7.0, "C")], SPIKE)
    known = spark.createDataFrame([(day(0), "Iran War")], "date date, label string")
    archive_rows = spark.createDataFrame(
        [(day(50), day(49), "Border Strike With Border Troops", "u", "d", "t", "C", -1),
         (day(50), day(51), "Troops March Over Border", "u", "d", "t", "C", 1)],
        "spike_date date, article_date date, title string, url string, domain string, themes string, "
        "dominant_category string, days_from_spike int",
    )
    labelled = archive.spike_labels(spikes, known, archive_rows)
    assert {r["date"]: r["label"] for r in labelled.collect()} == {
        day(0): "Iran War", day(50): "Border · Troops · March", day(90): "Geopolitical Event",
    }
    options = [r["option"] for r in archive.spike_options(labelled).collect()]
    assert options[0] == f"{day(90)} | Geopolitical Event"
    assert tables.known_events(spark).count() == 31
