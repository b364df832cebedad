import datetime
import gzip
import pathlib

import checks
import pytest
from pyspark.sql import functions as F

from stormglass import schemas
from stormglass.catalog.registry import inputs
from stormglass.plans import cli, jobs
from stormglass.session import shared_dir, stage
from stormglass.sources import news as news_source
from stormglass.sources import tables


def raw_line(record, date, themes, tone, url="https://x.example/military-strike-near-border-town.html"):
    fields = [f"f{i}" for i in range(1, 28)]
    for position, value in {1: record, 2: date, 4: "src", 5: url, 7: themes, 16: tone}.items():
        fields[position - 1] = value
    return "\t".join(fields)


def test_unbalanced_quote_keeps_fields_apart(spark, tmp_path):
    path = tmp_path / "news.tsv"
    path.write_text('1\t20200101\t"src\thttp://u\tWAR"\t0,1,2\tCONFLICT\n2\t20200102\ts\tu\tt\t1\n')
    rows = news_source.scan_news_tsv(spark, str(path)).orderBy("record_id").collect()
    assert tuple(rows[0]) == ("1", "20200101", '"src', "http://u", 'WAR"', "0,1,2", "CONFLICT")
    assert rows[1]["category"] is None


def test_raw_files_by_year(spark, tmp_path):
    for year in (2015, 2016, 2017):
        with gzip.open(tmp_path / f"{year}0101000000.gkg.csv.gz", "wt") as f:
            f.write(raw_line(f"r{year}", f"{year}0101120000", "MILITARY#RS#", "0,1,5.0") + "\n")
            f.write(raw_line(f"x{year}", f"{year}0101120000", "SPORTS", "0,1,5.0") + "\n")
            f.write("only\ttwo\n")
    raw = news_source.scan_raw_news(spark, str(tmp_path), first_year=2016, last_year=2018)
    found = news_source.ingest_raw_news(raw)
    assert {(r["record_id"], r["category"]) for r in found.collect()} == {
        ("r2016", "CONFLICT"), ("r2017", "CONFLICT")
    }
    assert found.columns == schemas.FILTERED_NEWS.names
    nested = tmp_path / "more" / "2031"
    nested.mkdir(parents=True)
    (nested / "late.csv").write_text(raw_line("r2031", "20310101120000", "MILITARY#RS#", "0,1,5.0") + "\n")
    every = news_source.ingest_raw_news(news_source.scan_raw_news(spark, str(tmp_path)))
    assert {r["record_id"] for r in every.collect()} == {"r2015", "r2016", "r2017", "r2031"}
    later = news_source.ingest_raw_news(news_source.scan_raw_news(spark, str(tmp_path), first_year=2017))
    assert {r["record_id"] for r in later.collect()} == {"r2017"}


def test_file_list(spark):
    lines = [
        "10 h http://a/v2/20160101000000.gkg.csv.zip", "10 h http://a/v2/20150101000000.gkg.csv.zip",
        "10 h http://a/v2/20160101000000.export.CSV.zip", "broken",
    ]
    listing = spark.createDataFrame([(line,) for line in lines], "value string")
    found = news_source.prune_files_by_year(listing, 2016, 2018)
    assert [r["path"] for r in found.collect()] == ["http://a/v2/20160101000000.gkg.csv.zip"]


@pytest.mark.parametrize("by", ["article_date", "article_month"])
def test_store(spark, tmp_path, by):
    rows = [(str(i), d, "s", "u", "WAR#RS#", "0,1,2.5,0", "CONFLICT")
            for i, d in enumerate(["20200101120000", "20200131120000", "20200201120000", "2020"])]
    path = str(tmp_path / "store")
    news = spark.createDataFrame(rows, schemas.FILTERED_NEWS)
    for _ in range(2):  # overwrites
        news_source.write_news_store(news, path, by)
    store = news_source.scan_news_store(spark, path)
    assert store.count() == 4 and store.filter("article_date IS NULL").count() == 1
    assert news_source.store_as_articles(store).count() == 3
    folders = {p.name for p in pathlib.Path(path).iterdir() if p.is_dir()}
    assert len(folders) == (4 if by == "article_date" else 3)


@pytest.mark.parametrize("by", ["article_date", "article_month"])
def test_update_never_deletes(spark, tmp_path, by):
    def news(*records):
        rows = [(i, d, s, "u", "WAR#RS#", "0,1,2.5,0", "CONFLICT") for i, d, s in records]
        return spark.createDataFrame(rows, schemas.FILTERED_NEWS)

    path = str(tmp_path / "store")
    first = [("1", "20200101", "a"), ("2", "20200101", "a"), ("3", "bad", "a")]
    second = [("4", "20200101", "a"), ("5", "worse", "a"), ("2", "20200101", "b"), ("6", "20200301", "b"), ("6", "20200301", "a"),
              (None, "20200101", "a"), (None, "20200101", "a")]
    for load in (first, second, second[:5]):
        news_source.write_news_store(news(*load), path, by, update=True)
    store = news_source.scan_news_store(spark, path).collect()
    assert sorted((r["record_id"], r["source"]) for r in store if r["record_id"]) == [
        ("1", "a"), ("2", "a"), ("3", "a"), ("4", "a"), ("5", "a"), ("6", "a")]
    assert sum(r["record_id"] is None for r in store) == 2
    news_source.write_news_store(news(("7", "20200104", "a")), path, by)
    assert news_source.scan_news_store(spark, path).count() == 1


@pytest.mark.parametrize("by", ["article_date", "article_month"])
def test_update_reads_the_partitions_of_its_load_only(spark, tmp_path, by, monkeypatch):
    def news(*records):
        return spark.createDataFrame([(i, d, "s", "u", "WAR#RS#", "0,1,2.5,0", "CONFLICT") for i, d in records], schemas.FILTERED_NEWS)

    path = str(tmp_path / "store")
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=k) for k in range(60)]
    every = [(f"{k}-{day}", f"{day:%Y%m%d}") for day in days for k in range(2)] + [("bad", "2020")]
    assert news_source.write_news_store(news(*every), path, by) == 121
    load = [("0-2020-01-05", "20200105"), ("new", "20200105"), ("bad", "2020"), ("worse", "20")]
    fresh = news_source.not_stored(news_source.as_store_rows(news(*load)), path, by)
    assert {r["record_id"] for r in fresh.collect()} == {"new", "worse"}
    stored = news_source.scan_news_store(spark, path)
    touched = stored.where(news_source._in_partitions(stored, by, news_source.as_store_rows(news(*load))))
    text = checks.plan(touched)
    assert "PartitionFilters: []" not in text and by in text.split("PartitionFilters")[1]
    read = {pathlib.Path(r["f"]).parent.name for r in touched.select(F.input_file_name().alias("f")).collect()}
    assert len(read) == 2 and any("__HIVE_DEFAULT_PARTITION__" in name for name in read)
    monkeypatch.setattr(news_source, "NAMED_PARTITIONS", 0)
    ranged = stored.where(news_source._in_partitions(stored, by, news_source.as_store_rows(news(*load[:2]))))
    assert {r["record_id"] for r in ranged.collect()} >= {"0-2020-01-05", "1-2020-01-05"} and ranged.count() < 121
    assert news_source.write_news_store(news(*load), path, by, update=True) == 2
    assert news_source.write_news_store(news(*load), path, by, update=True) == 0


def test_write_table_counts_and_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.write_table(spark.range(7), path) == 7
    assert tables.write_table(spark.range(3), path) == 3
    tables.append_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 5


def test_a_failed_overwrite_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(7), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.write_table(spark.range(9).select((F.lit(1) / (F.col("id") - 8)).alias("id")), path)
    assert spark.read.parquet(path).count() == 7
    assert tables.write_table(spark.read.parquet(path).where("id > 2"), path) == 4  # reads what it replaces
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_sorted_table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_sorted(spark.range(100).orderBy("id", ascending=False), path, "id")
    assert [r["id"] for r in spark.read.parquet(path).collect()] == list(range(100))


def test_stage_reads_back_from_the_shared_folder(spark):
    staged = stage(spark.range(5), "numbers")
    assert staged.count() == 5
    assert shared_dir(spark) in staged.inputFiles()[0]


def test_live_lines(spark, tmp_path):
    good = [f"f{i}" for i in range(27)]
    (tmp_path / "a.csv").write_text("\n".join(["\t".join(good), "\t".join([*good, "more"]), "a\tb"]))
    rows = news_source.scan_live_news(spark, str(tmp_path)).collect()
    assert {tuple(r) for r in rows} == {("f1", "f3", "f4", "f7", "f15"), ("b", None, None, None, None)}


def test_all_jobs_by_command_line(spark, tmp_path):
    """Raw files to labelled spikes: 336 days, five of them with a shock."""
    raw = tmp_path / "raw"
    raw.mkdir()
    days = [f"2019{m:02d}{d:02d}" for m in range(1, 13) for d in range(1, 29)]
    with open(raw / "2019.gkg.csv", "w") as f:
        for i, day in enumerate(days):
            tone = "0,1,40.0,0" if 150 <= i < 155 else f"0,1,{3 + i % 3}.0,0"
            for k in range(3):
                f.write(raw_line(f"{i}-{k}", f"{day}120000", "MILITARY#RS#", tone) + "\n")
    nanos = "unix_micros(cast(to_date('2019-01-01') + cast(id as int) as timestamp)) * 1000"
    spark.range(360).selectExpr(f"{nanos} AS Date", "100.0 + id AS XOM", "200.0 - id / 4 AS AAPL").write.parquet(
        str(tmp_path / "prices"))
    at = {n: str(tmp_path / n) for n in (
        "store", "index", "spikes", "percentiles", "by_spike", "curve", "summary", "risk", "exposure",
        "news", "labels")}
    cli.main(["ingest", "--raw", str(raw), "--out", at["store"], "--by", "article_month"])
    cli.main(["tension", "--news", at["store"], "--index-out", at["index"], "--spikes-out", at["spikes"],
              "--percentiles-out", at["percentiles"]])
    cli.main(["event-window", "--prices", str(tmp_path / "prices"), "--spikes", at["spikes"],
              "--by-spike-out", at["by_spike"], "--curve-out", at["curve"], "--summary-out", at["summary"]])
    cli.main(["portfolio", "--summary", at["summary"], "--risk-out", at["risk"], "--exposure-out", at["exposure"]])
    cli.main(["spike-news", "--news", at["store"], "--spikes", at["spikes"], "--out", at["news"]])
    cli.main(["labels", "--spikes", at["spikes"], "--spike-news", at["news"], "--out", at["labels"]])
    vix = "make_timestamp(2019, 1, 1, 15, 0, 0) + make_interval(0, 0, 0, cast(id as int)) AS t"
    spark.range(360).selectExpr("to_date('2019-01-01') + cast(id as int) AS date", "20.0D AS vix").write.parquet(
        str(tmp_path / "vix"))
    spark.range(3).selectExpr(vix, "id").selectExpr("t AS timestamp", "20.0D + id AS vix").write.parquet(str(tmp_path / "minutes"))
    cli.main(["event-view", "--index", at["index"], "--vix", str(tmp_path / "vix"), "--spikes", at["spikes"],
              "--by-spike", at["by_spike"], "--spike-news", at["news"], "--out", str(tmp_path / "view"),
              "--day", "2019-06-12"])
    cli.main(["risk-snapshot", "--index", at["index"], "--summary", at["summary"], "--out", str(tmp_path / "snapshot")])
    cli.main(["live-chart", "--live", str(tmp_path / "none"), "--vix-minutes", str(tmp_path / "minutes"), "--index",
              at["index"], "--vix", str(tmp_path / "vix"), "--out", str(tmp_path / "chart"), "--now", "2019-01-02 15:30:00"])
    assert spark.read.parquet(str(tmp_path / "view" / "chart")).count() == 11
    assert {r["sector"] for r in spark.read.parquet(str(tmp_path / "view" / "sectors")).collect()} >= {"Energy"}
    assert spark.read.parquet(str(tmp_path / "view" / "news")).count() == 6
    assert spark.read.parquet(str(tmp_path / "snapshot")).count() == 1
    assert {r["series"] for r in spark.read.parquet(str(tmp_path / "chart")).collect()} == {"vix"}
    read = {n: spark.read.parquet(p) for n, p in at.items() if n != "store"}
    assert read["index"].count() == len(days)
    assert {str(r["date"]) for r in read["spikes"].collect()} == {f"2019-06-{d}" for d in range(11, 16)}
    assert read["by_spike"].count() == 5 * 2 * 61
    assert read["curve"].count() == 2 * 61
    assert read["exposure"].count() == 3
    assert read["news"].count() == 5 * 7 * 3
    assert read["labels"].first()["label"] == "Border · Military · Near"
    assert read["risk"].first()["weighted_avg_return_5d"] is not None


def test_index_by_updates_on_the_command_line(spark, tmp_path, capsys):
    at = {n: str(tmp_path / n) for n in ("store", "state", "index", "spikes", "percentiles", "whole", "whole_spikes")}
    for load in range(2):
        raw = tmp_path / f"raw{load}"
        raw.mkdir()
        with open(raw / f"{load}.gkg.csv", "w") as f:
            for i in range(60):
                f.write(raw_line(f"{load}-{i}", f"2019{1 + load:02d}{1 + i % 28:02d}120000", "MILITARY;WB_1;1#X#RS#", f"0,1,{i % 9}.5,0") + "\n")
            f.write(raw_line(f"{load}-none", "20190101120000", "SPORTS", "0,1,5.0,0") + "\n")
        for _ in range(2):  # the second time, nothing is new
            cli.main(["ingest", "--raw", str(raw), "--out", at["store"], "--index", at["state"]])
    said = [line for line in capsys.readouterr().out.splitlines() if line.startswith("{")]
    assert said == ["{'lines': 61, 'stored': 60}", "{'lines': 61, 'stored': 0}"] * 2
    cli.main(["tension-update", "--index", at["state"], "--index-out", at["index"], "--spikes-out", at["spikes"],
              "--percentiles-out", at["percentiles"]])
    cli.main(["tension", "--news", at["store"], "--index-out", at["whole"], "--spikes-out", at["whole_spikes"]])
    tables_ = [[(r["date"], round(r["geo_tension_index"], 9), r["total_events"]) for r in
                spark.read.parquet(at[n]).orderBy("date").collect()] for n in ("index", "whole")]
    assert tables_[0] == tables_[1] and len(tables_[0]) == 56


def test_tsv_and_store_give_the_same_index(spark, tmp_path):
    lines = [f"{i}\t202001{1 + i % 28:02d}\ts\thttp://x.example/a-b\tWAR#RS#\t0,1,{i % 7}.25\tCONFLICT"
             for i in range(300)]
    text = tmp_path / "news.tsv"
    text.write_text("\n".join(lines))
    news_source.write_news_store(news_source.scan_news_tsv(spark, str(text)), str(tmp_path / "store"))
    outs = []
    for source in ("news.tsv", "store"):
        index, spikes = str(tmp_path / f"i_{source}"), str(tmp_path / f"s_{source}")
        counts = jobs.run_tension(spark, str(tmp_path / source), index, spikes)
        assert counts["index"] == 28
        rows = spark.read.parquet(index).orderBy("date").collect()
        outs.append([(r["date"], round(r["geo_tension_index"], 9), r["total_events"]) for r in rows])
    assert outs[0] == outs[1]


def test_price_range_reaches_the_scan(spark, tmp_path):
    nanos = "unix_micros(cast(to_date('2019-01-01') + cast(id as int) as timestamp)) * 1000 + 5"
    spark.range(50).selectExpr(f"{nanos} AS Date", "100.0 + id AS XOM").write.parquet(str(tmp_path / "p"))
    days = {"first": datetime.date(2019, 1, 5), "last": datetime.date(2019, 1, 7)}
    found = tables.scan_long_prices(spark, str(tmp_path / "p"), **days)
    assert [str(r["date"]) for r in found.orderBy("date").collect()] == ["2019-01-05", "2019-01-06", "2019-01-07"]
    assert "GreaterThanOrEqual(Date," in found._jdf.queryExecution().executedPlan().toString()


def test_no_input_is_dealt_out_anew(spark):
    found = inputs(spark, "/root/testdata/sf0.001")
    for frame in (found.news, found.prices, found.live):
        assert "RoundRobin" not in frame._jdf.queryExecution().executedPlan().toString()
    assert inputs(spark, "/root/testdata/sf0.001") is found
