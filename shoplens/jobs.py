"""Command-line entry points (the reference's three applications).

    python -m shoplens.jobs offline --data DIR --condition '{"startDate": ...}' --out DIR
    python -m shoplens.jobs area    --data DIR [--top 3]
    python -m shoplens.jobs ads-batch --data DIR --out DIR [--batch-seconds 5 --threshold 20]
    python -m shoplens.jobs stream  --lines DIR | --kafka BROKERS --out DIR [--available-now]
    python -m shoplens.jobs stream-native --lines DIR | --kafka BROKERS --out DIR [--lateness "1 day"
                                          --slide "10 seconds" --arrival --available-now]

``offline`` runs Q1-Q5 for one condition (JSON with the reference's keys:
startDate, endDate, startAge, endAge, professionals, targetPageFlow) and
writes the five result tables; ``area`` prints Q6; ``stream`` runs Q7-Q10
continuously on the ad lines of a folder or a Kafka topic; ``stream-native`` does
so with Spark's own state, as three queries: the blacklist, and over its kept
clicks the totals with the top ads, and the sliding hour.

On a cluster, submit with the cluster's own settings; the shared folder for
lineage cuts is ``spark.checkpoint.dir``; a stream's checkpoint lies beside its
log under ``--out``.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from shoplens.params import Condition
from shoplens.session import prepare
from shoplens.sources.sinks import show_console


def _spark(master: str | None) -> SparkSession:
    b = SparkSession.builder.appName("shoplens")
    if master:
        b = b.master(master)
    return prepare(b.getOrCreate())


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="shoplens.jobs")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="job", required=True)
    off = sub.add_parser("offline")
    off.add_argument("--data", required=True)
    off.add_argument("--condition", required=True, help="condition JSON text")
    off.add_argument("--out", required=True)
    off.add_argument("--task-id", default=None)
    area = sub.add_parser("area")
    area.add_argument("--data", required=True)
    area.add_argument("--top", type=int, default=3)
    ab = sub.add_parser("ads-batch")
    ab.add_argument("--data", required=True)
    ab.add_argument("--out", required=True)
    ab.add_argument("--batch-seconds", type=int, default=5)
    ab.add_argument("--threshold", type=int, default=20)
    st = sub.add_parser("stream")
    src = st.add_mutually_exclusive_group(required=True)
    src.add_argument("--lines", help="folder of text files of ad lines")
    src.add_argument("--kafka", help="bootstrap servers of the ads_log topic")
    st.add_argument("--topic", default="ads_log")
    st.add_argument("--out", required=True)
    st.add_argument("--threshold", type=int, default=20)
    st.add_argument("--available-now", action="store_true",
                    help="process what has arrived, then stop (catch-up run)")
    na = sub.add_parser("stream-native")
    src = na.add_mutually_exclusive_group(required=True)
    src.add_argument("--lines", help="folder of text files of ad lines, read by byte offsets")
    src.add_argument("--kafka", help="bootstrap servers of the ads_log topic")
    na.add_argument("--topic", default="ads_log")
    na.add_argument("--out", required=True)
    na.add_argument("--threshold", type=int, default=20)
    na.add_argument("--starting", choices=("latest", "earliest"), default="latest")
    na.add_argument("--lateness", default="1 day", help="how late a click may come after the newest one")
    na.add_argument("--slide", default="10 seconds")
    na.add_argument("--arrival", action="store_true", help="the hour goes by arrival, not by the clicks' time")
    na.add_argument("--available-now", action="store_true", help="process what has arrived, then stop")
    args = ap.parse_args(argv)
    spark = _spark(args.master)

    if args.job == "offline":
        from shoplens.plans.offline import run_offline
        run_offline(spark, args.data, Condition.from_json(args.condition), args.task_id,
                    out_dir=args.out)
    elif args.job == "ads-batch":
        from shoplens.plans.offline import run_ads_batch
        run_ads_batch(spark, args.data, args.out, args.batch_seconds, args.threshold)
    elif args.job == "area":
        from shoplens.plans.offline import run_area_top
        show_console(run_area_top(spark, args.data, args.top), 100)
    elif args.job == "stream-native":
        _stream_native(spark, args)
    else:
        from shoplens.sources.ads import read_ads_kafka, read_ads_text_stream
        from shoplens.streaming import ads_stream as S
        lines = (read_ads_text_stream(spark, args.lines) if args.lines
                 else read_ads_kafka(spark, args.kafka, args.topic))
        ckpt = os.path.join(args.out, "_checkpoint")  # beside the log it belongs to
        clicks, _bad = S.clicks_from_lines(lines, os.path.join(args.out, "bad_lines"),
                                           os.path.join(ckpt, "bad_lines"))
        trigger = {"availableNow": True} if args.available_now else None
        q = S.start_blacklist_tables(clicks, args.out, os.path.join(ckpt, "blacklist"),
                                     args.threshold, trigger=trigger)
        if args.available_now:
            q.awaitTermination()
            if _bad is not None:
                _bad.processAllAvailable()
                _bad.stop()
        else:
            spark.streams.awaitAnyTermination()


def _stream_native(spark: SparkSession, args: argparse.Namespace) -> None:
    from shoplens.sources.ads import read_ads_kafka
    from shoplens.sources.line_log import read_line_stream
    from shoplens.streaming import ads_stream, blacklist, sliding, totals
    if args.lines:
        lines = read_line_stream(spark, args.lines, args.starting).select("value")
    else:
        lines = read_ads_kafka(spark, args.kafka, args.topic, args.starting)
    folder = lambda *parts: os.path.join(args.out, *parts)
    clicks, bad = ads_stream.clicks_from_lines(lines, folder("bad_lines"), folder("_checkpoint", "bad_lines"))
    trigger = {"availableNow": True} if args.available_now else None
    first = blacklist.start_blacklist_cells(clicks, folder("blacklist"), folder("_checkpoint", "blacklist"),
                                            args.threshold, args.lateness, trigger=trigger)
    if args.available_now:
        first.awaitTermination()
        bad.processAllAvailable()
        bad.stop()
    kept = blacklist.kept_stream(spark, folder("blacklist"))
    later = [totals.start_totals(kept, folder("totals"), folder("_checkpoint", "totals"), args.lateness, trigger=trigger),
             sliding.start_sliding(kept, folder("sliding"), folder("_checkpoint", "sliding"), args.slide,
                                   lateness=args.lateness, arrival=args.arrival, trigger=trigger)]
    if args.available_now:
        for q in later:
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
