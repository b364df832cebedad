"""Command line of the jobs, for spark-submit: stormglass_job.py JOB --option value ...

ingest         raw news files (of some years) -> news store, new or added to (and to an index store)
tension        news (TSV or store)          -> daily index, spikes, percentiles
tension-update index store                  -> the same tables, without reading news
event-window   price files and spikes       -> reactions by spike, curve, ticker summary
portfolio      ticker summary, holdings     -> risk summary, exposure
spike-news     news and spikes              -> supporting news
labels         spikes and spike news        -> labelled spikes
event-view     index, vix, spikes, reactions -> chart, sector impact and news of spikes
risk-snapshot  index, ticker summary        -> current score, level and portfolio figures
live-chart     live tables, index, vix      -> points of the live chart
live           folder of live files         -> stream of articles, readings, latest news
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from stormglass import fixed_values as V
from stormglass.operators import archive
from stormglass.plans import index_store, jobs
from stormglass.session import build_session
from stormglass.sources import tables
from stormglass.streaming import live


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    commands = top.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str, **optional) -> None:
        command = commands.add_parser(name)
        for option in required:
            command.add_argument(f"--{option}", required=True)
        for option, default in optional.items():
            kind = type(default) if default is not None else str
            command.add_argument(f"--{option.replace('_', '-')}", type=kind, default=default)

    job("ingest", "raw", "out", first_year=None, last_year=None, by="article_date", update=0,
        index=None)
    job("tension", "news", "index-out", "spikes-out", percentiles_out=None, sigmas=V.SPIKE_SIGMAS,
        accuracy=None)
    job("tension-update", "index", "index-out", "spikes-out", percentiles_out=None, sigmas=V.SPIKE_SIGMAS, sketched=0)
    job("event-window", "prices", "spikes", "by-spike-out", "curve-out", "summary-out")
    job("portfolio", "summary", "risk-out", "exposure-out", holdings=None)
    job("spike-news", "news", "spikes", "out", per_spike=V.NEWS_PER_SPIKE)
    job("labels", "spikes", "spike-news", "out")
    job("event-view", "index", "vix", "spikes", "by-spike", "spike-news", "out", day=None)
    job("risk-snapshot", "index", "summary", "out", holdings=None)
    job("live-chart", "live", "vix-minutes", "index", "vix", "out", now=None)
    job("live", "folder", "percentiles", "out", "checkpoint", once=0, files_per_batch=1000)
    return top


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"stormglass-{args.job}")
    if args.job == "ingest" and args.index:
        print(index_store.run_ingest_load(
            spark, args.raw, args.out, args.index, _number(args.first_year), _number(args.last_year), args.by))
    elif args.job == "ingest":
        print(jobs.run_ingest(
            spark, args.raw, args.out, _number(args.first_year), _number(args.last_year), args.by, bool(args.update)))
    elif args.job == "tension-update":
        index_store.run_tension_of_store(
            spark, args.index, args.index_out, args.spikes_out, args.percentiles_out, args.sigmas, bool(args.sketched))
    elif args.job == "tension":
        jobs.run_tension(
            spark, args.news, args.index_out, args.spikes_out, args.percentiles_out, args.sigmas,
            _number(args.accuracy),
        )
    elif args.job == "event-window":
        jobs.run_event_window(
            spark, args.prices.split(","), args.spikes, args.by_spike_out, args.curve_out,
            args.summary_out,
        )
    elif args.job == "portfolio":
        holdings = spark.read.parquet(args.holdings) if args.holdings else None
        jobs.run_portfolio(spark, args.summary, args.risk_out, args.exposure_out, holdings)
    elif args.job == "spike-news":
        jobs.run_spike_news(spark, args.news, args.spikes, args.out, args.per_spike)
    elif args.job == "labels":
        labelled = archive.spike_labels(
            spark.read.parquet(args.spikes), tables.known_events(spark),
            spark.read.parquet(args.spike_news),
        )
        tables.write_table(labelled, args.out)
    elif args.job == "event-view":
        jobs.run_event_view(
            spark, args.index, args.vix, args.spikes, args.by_spike, args.spike_news, args.out,
            date.fromisoformat(args.day) if args.day else None,
        )
    elif args.job == "risk-snapshot":
        holdings = spark.read.parquet(args.holdings) if args.holdings else None
        jobs.run_risk_snapshot(spark, args.index, args.summary, args.out, holdings)
    elif args.job == "live-chart":
        now = datetime.fromisoformat(args.now) if args.now else None
        jobs.run_live_chart(spark, args.live, args.vix_minutes, args.index, args.vix, args.out, now)
    elif args.job == "live":
        # One stream feeds all live tables; if it fails, the job ends with its error.
        live.start(
            spark, args.folder, args.percentiles, args.out, args.checkpoint, bool(args.once), args.files_per_batch
        ).awaitTermination()
        print(live.line_counts(spark, args.out))
