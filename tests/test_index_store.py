"""The index kept up to date by loads is the index of one run over all articles."""

import checks
import pytest
from pyspark.sql import functions as F

from stormglass import schemas
from stormglass.operators import cleaning, tension
from stormglass.plans import index_store, jobs
from stormglass.sources import news as news_source
from stormglass.streaming.segments import Store


@pytest.fixture(scope="module")
def news(spark):
    rows = [(str(i), f"20{18 + i % 3}{1 + i % 12:02d}{1 + i % 28:02d}120000" if i % 17 else "bad", "s", "http://x.example/a-b",
             "WAR#RS#" if i % 5 else "WAR#US#", f"0,1,{i % 43}.{i % 10}7,0", "CONFLICT" if i % 3 else "SPECIAL") for i in range(900)]
    return spark.createDataFrame(rows, schemas.FILTERED_NEWS).cache()


def table(frame):
    rounded = frame.withColumn("geo_tension_index", F.round("geo_tension_index", 9))
    return checks.normal(rounded.select("date", "geo_tension_index", "total_events", "dominant_category").collect())


@pytest.fixture(scope="module")
def whole(news):
    return table(jobs.tension_index(cleaning.clean_news(news)).daily)


def test_loads_in_any_order_give_the_index_of_one_run(spark, news, whole, tmp_path):
    store = index_store.index_store(spark, str(tmp_path / "i"), fan=2)
    for load in (3, 0, 4, 1, 2):
        index_store.add_load(cleaning.clean_news(news.where(F.col("record_id").cast("int") % 5 == load)), store)
    index_store.add_load(cleaning.clean_news(news.limit(0)), store)
    assert table(index_store.current_index(store).daily) == whole
    assert len(store.manifest().segments("partials")) <= 3


def test_a_load_reads_its_own_articles_and_makes_sketches_of_its_months(spark, news, tmp_path):
    store = index_store.index_store(spark, str(tmp_path / "i"))
    index_store.add_load(cleaning.clean_news(news), store)
    more = spark.createDataFrame([("x", "20190305", "s", "u", "WAR#RS#", "0,1,9.0,0", "CONFLICT")], schemas.FILTERED_NEWS)
    index_store.add_load(cleaning.clean_news(more), store)
    last = store.read("sketches", store.manifest().segments("sketches")[-1:]).collect()
    assert [str(r["month"]) for r in last] == ["2019-03-01"]
    exact, sketched = (index_store.current_index(store, sketched=s).percentiles.first() for s in (False, True))
    # Fewer days than a sketch holds exactly.
    assert abs(exact["p99"] - sketched["p99"]) < 0.2 * abs(exact["p99"]) and abs(exact["p1"] - sketched["p1"]) < 0.2 * exact["p99"]
    profile = tension.daily_profile(cleaning.clean_news(news.unionByName(more)))
    ranked = profile.agg(F.avg((F.col("geo_tension_raw") <= sketched["p99"]).cast("double")).alias("r")).first()["r"]
    assert abs(ranked - 0.99) < 0.02


def test_a_load_added_again_replaces_itself(spark, news, whole, tmp_path):
    store = index_store.index_store(spark, str(tmp_path / "i"))
    clean = cleaning.clean_news(news)
    index_store.add_load(clean.where("date < '2019-01-01'"), store)
    for _ in range(3):
        index_store.add_load(clean.where("date >= '2019-01-01'"), store, load=1)
    assert table(index_store.current_index(store).daily) == whole


@pytest.mark.parametrize("dies", ["add_load", "append_to_store", "last commit"])
def test_an_update_that_dies_is_made_good_by_the_next(spark, news, whole, tmp_path, monkeypatch, dies):
    store, path = index_store.index_store(spark, str(tmp_path / "i")), str(tmp_path / "store")

    class Died(Exception):
        pass

    def died(*args, **kwargs):
        raise Died

    first, second = news.where("cast(record_id AS int) % 2 = 0"), news.where("cast(record_id AS int) % 2 = 1 OR record_id < '3'")
    assert index_store.ingest_load(first, path, store) == 450
    with monkeypatch.context() as patched:
        if dies == "add_load":
            patched.setattr(Store, "commit", died)
        elif dies == "append_to_store":
            patched.setattr(news_source, "append_to_store", died)
        else:
            commit, seen = Store.commit, []
            patched.setattr(Store, "commit", lambda s, m: died() if seen else (seen.append(1), commit(s, m)))
        with pytest.raises(Died):
            index_store.ingest_load(second, path, store)
    index_store.ingest_load(second, path, store)
    index_store.ingest_load(second, path, store)
    assert table(index_store.current_index(store).daily) == whole
    assert news_source.scan_news_store(spark, path).count() == 900


def test_an_empty_store_gives_an_empty_index(spark, tmp_path):
    store = index_store.index_store(spark, str(tmp_path / "i"))
    assert index_store.current_index(store).daily.count() == 0
    assert index_store.current_index(store, sketched=True).percentiles.collect()[0]["p1"] is None
