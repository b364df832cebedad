import datetime as dt
import random

import checks
import pytest
from pyspark.sql import functions as F

from stormglass import schemas
from stormglass.operators import archive, cleaning
from stormglass.sources import news as news_source
from stormglass.streaming import live, segments

START = dt.datetime(2024, 1, 1, 12, 0)


def line(minute, slug="military-strike-near-border", themes="MILITARY", tone="0,1,5.0,0", number=None, source="src"):
    fields = [f"f{i}" for i in range(schemas.RAW_NEWS_WIDTH)]
    moment = (START + dt.timedelta(minutes=minute)).strftime("%Y%m%d%H%M%S")
    url = f"https://x.example/{slug}-{minute if number is None else number}.html"
    for position, value in zip((1, 3, 4, 7, 15), (moment, source, url, themes, tone), strict=True):
        fields[position] = value
    return "\t".join(fields)


class Feed:
    """A folder that gets one file after another, and the stream on it."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, path
        self.folder, self.out = path / "in", str(path / "out")
        self.folder.mkdir()
        self.files = 0
        spark.createDataFrame([(0.0, 20.0)], "p1 double, p99 double").write.parquet(str(path / "p"))

    def put(self, *lines):
        (self.folder / f"{self.files}.csv").write_text("\n".join(lines) + "\n")
        self.files += 1

    def run(self, files_per_batch=1, n=10):
        live.start(self.spark, str(self.folder), str(self.path / "p"), self.out, str(self.path / "c"), True,
                   files_per_batch, n).awaitTermination()
        return self

    def readings(self):
        return {r["timestamp"].strftime("%d %H:%M"): r["total_events"] for r in live.current_readings(self.spark, self.out).collect()}

    def tables(self):
        found = (live.current_articles(self.spark, self.out), live.current_latest(self.spark, self.out),
                 live.current_readings(self.spark, self.out))
        return [checks.normal(t.select(*sorted(t.columns)).collect()) for t in found]


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_a_batch_finds_the_smallest_row_of_an_article_in_one_pass(feed, monkeypatch):
    def another_pass(rows):
        raise AssertionError("rows of a batch are grouped once, with the stored ones")

    monkeypatch.setattr(live, "_first_of_each", another_pass)
    feed.put(line(1, source="c"), line(1, source="b"), line(1, source="b"), line(2, source="z"))
    feed.put(line(1, source="a"), line(1, source="d"), line(2, source="zz"), line(3, source="y"), line(3, source="x"))
    feed.run()
    found = {r["time"].minute: r["source"] for r in live.current_rows(feed.spark, feed.out).collect()}
    assert found == {1: "a", 2: "z", 3: "x"}
    assert feed.readings() == {"01 12:00": 3}


def test_any_batch_split_and_file_order_give_the_same_tables(spark, tmp_path):
    draw = random.Random(4)
    lines = [line(m * 37 % 4000, tone=f"0,1,{m % 50}.5,0", number=m % 150) for m in range(200)]
    lines += [line(m * 37 % 4000, tone=f"0,1,{(m + 7) % 50}.5,0", number=m % 150) for m in range(0, 200, 9)]
    found = []
    for run, size in enumerate((1, 2, 1000)):
        (tmp_path / str(run)).mkdir()
        feed = Feed(spark, tmp_path / str(run))
        order = lines[:]
        draw.shuffle(order)
        for k in range(0, len(order), 40):
            feed.put(*order[k:k + 40])
        feed.put(*order[:30])  # a file that comes again
        found.append(feed.run(size).tables())
    assert found[0] == found[1] == found[2]
    batch = live.drop_repeated(news_source.scan_live_news(spark, str(feed.folder)))
    articles = archive.live_articles(batch)
    assert found[0][0] == checks.normal(articles.select(*sorted(articles.columns)).collect())
    readings = live.tension_readings(news_source.scan_live_news(spark, str(feed.folder)), F.lit(0.0), F.lit(20.0))
    assert found[0][2] == checks.normal(readings.select(*sorted(readings.columns)).collect())


def test_stream_goes_on_where_it_stopped(feed):
    feed.put(line(0), line(1))
    assert feed.run().readings() == {"01 12:00": 2}
    feed.put(line(2), line(20))
    assert feed.run().readings() == {"01 12:00": 3, "01 12:15": 1}


def test_late_rows_always_count(feed):
    feed.put(line(0), line(60))
    feed.run()
    feed.put(line(31, number="late"), line(-60, number="hour"), line(-3 * 24 * 60, number="days"))
    assert feed.run().readings() == {"01 12:00": 1, "01 13:00": 1, "01 12:30": 1, "01 11:00": 1, "29 12:00": 1}


def test_repeats_give_one_row_whatever_the_order(spark):
    rows = [("20240101120000", s, "u", "MILITARY", t) for s, t in (("b", "0,1,2,0"), ("a", "0,1,9,0"), ("a", "0,1,3,0"))]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order + [("bad", "a", "u", "MILITARY", "x")], "date string, source string, url string, themes string, tone string")
        kept = live.drop_repeated(frame).collect()
        assert [(r["source"], r["tone"]) for r in kept] == [("a", "0,1,3,0")]
    # The same address at another time is another article.
    later = frame.unionByName(frame.withColumn("date", F.lit("20240101130000")))
    assert live.drop_repeated(later).count() == 2


def test_repeated_file_is_counted_once(feed):
    feed.put(line(0), line(1))
    feed.put(line(0), line(1))
    assert feed.run().readings() == {"01 12:00": 2}


def test_articles_table_has_no_repeats(spark, feed):
    feed.put(line(0), line(1), line(2, themes="SPORTS"), "broken line")
    feed.put(line(1), line(3, themes="PROTEST", slug="protest-threat-grows-in-town"))
    table = live.current_articles(spark, feed.run().out)
    assert sorted(r["category"] for r in table.collect()) == ["Military", "Military", "Political"]


def test_a_batch_run_again_changes_nothing(spark, feed):
    feed.put(line(0), line(1))
    feed.put(line(16), line(1))
    before = feed.run().tables()
    again = news_source.scan_live_news(spark, str(feed.folder / "1.csv"))
    live.update_tables(again, 1, feed.out, str(feed.path / "p"))
    assert feed.tables() == before


def test_latest_table_keeps_the_newest(spark, feed):
    for start in (0, 10, 5, 3):
        feed.put(*[line(start + k, number=f"{start}-{k}") for k in range(5)])
    feed.run(n=7)
    minutes = sorted(int((r["time"] - START).total_seconds() // 60) for r in live.current_latest(spark, feed.out).collect())
    assert minutes == [8, 9, 10, 11, 12, 13, 14]


def test_a_replaced_article_leaves_the_newest_and_an_older_one_returns(spark, feed):
    feed.put(*[line(k, number=k) for k in range(6)])
    # The same article again, with a source that sorts first and no theme of interest.
    feed.put(line(5, number=5, themes="SPORTS", source="a"), line(4, number=4, tone="0,1,1.0,0", source="a"))
    feed.run(n=3)
    found = [(int((r["time"] - START).total_seconds() // 60), r["source"]) for r in live.current_latest(spark, feed.out).collect()]
    assert sorted(found) == [(2, "src"), (3, "src"), (4, "a")]
    assert feed.readings() == {"01 12:00": 5}
    raw = news_source.scan_live_news(spark, str(feed.folder))
    batch = live.tension_readings(raw, F.lit(0.0), F.lit(20.0))
    assert feed.tables()[2] == checks.normal(batch.select(*sorted(batch.columns)).collect())


def test_segments_and_files_do_not_grow_with_the_batches(spark, feed):
    """Batches of new articles: what a batch lists and reads is bounded, and nothing is left that no manifest names."""
    percentiles, out = str(feed.path / "p"), feed.out
    store = live.live_store(spark, out, fan=2)
    sizes, files, held = [], [], []
    for batch in range(15):
        lines = [line(batch * 20 + k, number=f"{batch}-{k}") for k in range(3)] + [line(0, number="0-0")]
        (feed.folder / f"{batch}.csv").write_text("\n".join(lines) + "\n")
        rows = news_source.scan_live_news(spark, str(feed.folder / f"{batch}.csv"))
        manifest = live.update_tables(rows, batch, out, percentiles, fan=2)
        sizes.append(len(manifest.segments("rows")))
        files.append(len(list((feed.path / "out" / "rows").iterdir())))
        arrived = live.drop_repeated(rows)
        first, last = (int((START - dt.datetime(1970, 1, 1) + dt.timedelta(minutes=m)).total_seconds()) * 1_000_000
                       for m in (batch * 20, batch * 20 + 2))
        own = arrived.where(F.col("url").contains(f"{batch}-"))
        held.append(len(store.holding("rows", manifest, own, first, last)))
    assert max(sizes) <= 4 and max(files) <= 4 + 4
    assert set(held) == {1}
    assert live.current_rows(spark, out).count() == 45
    last, one_before = store.manifest(), store.manifest(before=14)
    named = {s.name for m in (last, one_before) for t in m.tables for s in m.segments(t)}
    on_disk = {f"{t}/{p.name}" for t in live.KINDS for p in (feed.path / "out" / t).glob("*")}
    assert on_disk == named
    assert sorted(p.name for p in (feed.path / "out" / "manifests").glob("*.json")) == ["13.json", "14.json"]


def test_key_filter_passes_over_foreign_keys(spark, tmp_path):
    store = segments.Store(spark, str(tmp_path / "s"), {"rows": segments.Kind("k bigint, time timestamp", "time", lambda r: r, ("k",))})
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.lit(START).alias("time"))
    found = store.write("rows", rows, "a", level=1)
    manifest = segments.Manifest(0, {"rows": (found,)})
    assert found.parts == 32 and found.rows == 20_000
    every = store.holding("rows", manifest, rows.where("k % 1000 = 7"), found.first, found.last)
    foreign = store.holding("rows", manifest, rows.withColumn("k", F.col("k") + 50_000), found.first, found.last)
    assert (every, foreign) == ([found], [])
    assert store.holding("rows", manifest, rows, found.last + 1, found.last + 2) == []


@pytest.mark.parametrize("dies_in", ["commit", "_clean", "merged"])
def test_a_batch_that_dies_loses_and_repeats_nothing(spark, feed, monkeypatch, dies_in):
    percentiles, rows = str(feed.path / "p"), []
    for batch in range(7):
        lines = [line(batch * 7 + k, number=f"{batch}-{k}", tone=f"0,1,{batch}.5,0") for k in range(3)]
        lines += [line(0, number="0-0", tone=f"0,1,{9 - batch}.0,0")]
        (feed.folder / f"{batch}.csv").write_text("\n".join(lines) + "\n")
        rows.append(news_source.scan_live_news(spark, str(feed.folder / f"{batch}.csv")))

    class Died(Exception):
        pass

    def died(*args, **kwargs):
        raise Died

    write = segments.Store.write

    def dies_when_merging(store, table, frame, name, level=0):
        found = write(store, table, frame, name, level)
        if level:
            raise Died
        return found

    for batch, frame in enumerate(rows):
        if batch in (3, 5):
            with monkeypatch.context() as patched:
                patched.setattr(segments.Store, "write" if dies_in == "merged" else dies_in,
                                dies_when_merging if dies_in == "merged" else died)
                try:
                    live.update_tables(frame, batch, feed.out, percentiles, fan=2)
                except Died:
                    pass
        live.update_tables(frame, batch, feed.out, percentiles, fan=2)
    raw = news_source.scan_live_news(spark, str(feed.folder))
    batch = live.tension_readings(raw, F.lit(0.0), F.lit(20.0))
    assert feed.tables()[2] == checks.normal(batch.select(*sorted(batch.columns)).collect())
    articles = archive.live_articles(live.drop_repeated(raw))
    assert feed.tables()[0] == checks.normal(articles.select(*sorted(articles.columns)).collect())


def test_lines_that_are_none_go_to_a_side_table(spark, feed):
    feed.put(line(0), line(1) + "\tmore", "broken")
    feed.put(line(2), line(1) + "\tmore")
    feed.run()
    found = live.quarantined(spark, feed.out)
    assert sorted((r["file"].split("/")[-1], r["reason"]) for r in found.collect()) == [
        ("0.csv", "no valid time"), ("0.csv", "too many fields"), ("1.csv", "too many fields")]
    assert {r["line"] for r in found.collect()} == {line(1) + "\tmore", "broken"}
    assert live.line_counts(spark, feed.out) == {"lines": 5, "kept": 2, "quarantined": 3}


def test_failed_stream_ends_with_its_error(spark, feed):
    feed.put(line(0))
    with pytest.raises(Exception, match="nowhere"):
        live.start(spark, str(feed.folder), str(feed.path / "nowhere"), feed.out, str(feed.path / "c"), True).awaitTermination()


def test_feed_items_and_today(spark):
    rows = [(START + dt.timedelta(minutes=m), title, "s", "Military") for m, title in [
        (0, "Military Strike Near Border Town"), (1, "Protest Threat Grows In Decade"),
        (2, "Troops Cross River In The North")]]
    frame = spark.createDataFrame(rows, "time timestamp, title string, source string, category string")
    shown = archive.feed_items(archive.latest_news(frame)).collect()
    assert [(r["title"], r["clock"][3:]) for r in shown] == [
        ("Troops Cross River In The North", "02 UTC"), ("Military Strike Near Border Town", "00 UTC")
    ]
    today = cleaning.same_day(frame, F.lit("2024-01-02 00:00:00").cast("timestamp"), "time")
    assert today.count() == 0


def test_titles_are_made_for_the_latest_rows_only(spark, feed, monkeypatch):
    seen = []
    live_articles = archive.live_articles

    def counted(rows):
        seen.append(rows.count())
        return live_articles(rows)

    feed.put(*[line(k, number=k) for k in range(300)])
    feed.put(*[line(k, number=k, themes="SPORTS") for k in range(300, 600)], line(299, number="z", slug="other-strike-near-border-town"))
    rows = [news_source.scan_live_news(spark, str(feed.folder / f"{k}.csv")) for k in range(2)]
    monkeypatch.setattr(live.archive, "live_articles", counted)
    found = live.update_tables(rows[0], 0, feed.out, str(feed.path / "p"), n=2).facts["latest"]
    assert [int((r[0] - 1704110400000000) // 60_000_000) for r in found] == [299, 298] and seen == [200]
    # No article is among the latest rows: all are searched.
    found = live.update_tables(rows[1], 1, feed.out, str(feed.path / "p"), n=2).facts["latest"]
    assert [int((r[0] - 1704110400000000) // 60_000_000) for r in found] == [299, 299] and seen == [200, 200, 301]
