"""The reports as batch jobs on files: `spark-submit jobs.py <job> --out <folder> ...`.

Each job reads its sources, applies one operator and writes the result; `--format`
chooses tab-separated text, CSV with header, parquet or, for the rating reports,
fixed-width lines with their head and closing lines.

The jobs named `stream-...` are the hops of the streaming chain: they read what arrives in a
folder of messages, or in the table of the hop before, write to `--out`, and keep their place
in `--checkpoint`. With `--every` they go on for ever, else they end when all is read.
"""

from __future__ import annotations

import argparse
import importlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyforge import schemas
from tallyforge.functions.stopwords import VIETNAMESE
from tallyforge.operators import frames, ratings, sales, text
from tallyforge.session import get_session
from tallyforge.sinks import files, reports
from tallyforge.sources import lines
from tallyforge.sources import ratings as rating_files
from tallyforge.sources import reviews as review_files
from tallyforge.sources import sales as sales_files
from tallyforge.sources.messages import stream_lines
from tallyforge.streaming import batches, detect, ingest, stats, store

Args = argparse.Namespace
Job = Callable[[SparkSession, Args], DataFrame]


def _stopwords(spark: SparkSession, args: Args):
    return lines.read_stopwords(spark, args.stopwords) if args.stopwords else VIETNAMESE


def _reviews(spark: SparkSession, args: Args) -> DataFrame:
    return review_files.read_reviews(spark, *args.reviews)


def _clean_comments(spark: SparkSession, args: Args) -> DataFrame:
    stop = _stopwords(spark, args)
    return text.clean_text(_reviews(spark, args), "comment", stop).select("cleaned")


def _clean_lines(spark: SparkSession, args: Args) -> DataFrame:
    stop = _stopwords(spark, args)
    whole = lines.read_lines(spark, *args.reviews)
    return text.clean_text(whole, "value", stop).select("cleaned")


def _word_frequency(spark: SparkSession, args: Args) -> DataFrame:
    stop = _stopwords(spark, args)
    return text.word_frequency(_reviews(spark, args), "comment", stop, args.min_count)


def _top_words(*classes: str) -> Job:
    def run(spark: SparkSession, args: Args) -> DataFrame:
        reviews = _reviews(spark, args)
        if "sentiment" in classes:
            reviews = text.with_sentiment(reviews)
        top = text.top_words(reviews, classes, "comment", _stopwords(spark, args), args.top)
        return text.top_words_line(top, classes)

    return run


def _ratings(spark: SparkSession, args: Args) -> DataFrame:
    return rating_files.read_ratings(spark, *args.ratings)


def _items(spark: SparkSession, args: Args) -> DataFrame:
    return rating_files.read_items(spark, *args.items)


def _users(spark: SparkSession, args: Args) -> DataFrame:
    return rating_files.read_users(spark, *args.users)


def _rated_items(spark: SparkSession, args: Args) -> DataFrame:
    stats = ratings.item_average(_ratings(spark, args), args.min_ratings)
    return ratings.with_title(stats, _items(spark, args))


def _top_item(spark: SparkSession, args: Args) -> DataFrame:
    return ratings.top_item(_rated_items(spark, args))


def _rated_labels(spark: SparkSession, args: Args) -> DataFrame:
    averages = ratings.label_average(_ratings(spark, args), _items(spark, args))
    return ratings.by_average(averages, "label")


def _rated_by(attribute: str) -> Job:
    def run(spark: SparkSession, args: Args) -> DataFrame:
        users = ratings.with_band(_users(spark, args), "age", "age_band")
        averages = ratings.attribute_average(_ratings(spark, args), users, attribute)
        return ratings.with_title(averages, _items(spark, args))

    return run


def _rated_occupations(spark: SparkSession, args: Args) -> DataFrame:
    names = rating_files.read_occupations(spark, *args.occupations)
    averages = ratings.dimension_average(
        _ratings(spark, args), _users(spark, args), names, "occupation_id", "occupation"
    )
    return ratings.by_average(averages, "occupation")


def _rated_years(spark: SparkSession, args: Args) -> DataFrame:
    return ratings.by_year(ratings.year_average(_ratings(spark, args), args.zone))


def _orders(spark: SparkSession, args: Args) -> DataFrame:
    return sales_files.read_orders(spark, args.orders)


def _customers(spark: SparkSession, args: Args) -> DataFrame:
    return sales_files.read_customers(spark, args.customers)


def _order_items(spark: SparkSession, args: Args) -> DataFrame:
    return sales_files.read_order_items(spark, args.order_items)


def _valid_reviews(spark: SparkSession, args: Args) -> DataFrame:
    return sales.valid_reviews(sales_files.read_order_reviews(spark, args.order_reviews))


def _revenue(spark: SparkSession, args: Args) -> DataFrame:
    products = sales_files.read_products(spark, args.products)
    return sales.revenue_by_category(
        _orders(spark, args), _order_items(spark, args), products, args.year
    )


def _segments(spark: SparkSession, args: Args) -> DataFrame:
    valued = sales.order_values(_orders(spark, args), _order_items(spark, args))
    return sales.customer_segments(valued)


def _events(spark: SparkSession, args: Args) -> DataFrame:
    return store.read_events(spark, args.events)


def _newest(spark: SparkSession, args: Args):
    return store.newest_events(spark, args.events)


def _boxes(spark: SparkSession, args: Args) -> DataFrame:
    if args.frame:
        return store.boxes_of_frame(spark, args.boxes, args.events, args.frame)
    return store.read_boxes(spark, args.boxes, args.events)


def _trigger(args: Args) -> dict[str, bool | str]:
    return {"processingTime": args.every} if args.every else {"availableNow": True}


def _messages(spark: SparkSession, args: Args) -> DataFrame:
    return stream_lines(spark, args.inbox, args.max_files)


def _stream_ingest(spark: SparkSession, args: Args) -> StreamingQuery:
    return ingest.start_ingest(
        _messages(spark, args), args.out, args.rejects, args.checkpoint, **_trigger(args)
    )


def _stream_detect(spark: SparkSession, args: Args) -> StreamingQuery:
    module, _, name = args.detector.partition(":")
    frame_stream = batches.stream_table(spark, args.inbox, schemas.FRAME)
    return detect.start_detect(
        frame_stream, getattr(importlib.import_module(module), name), args.out, args.rejects,
        args.checkpoint, list_size=args.list_size, **_trigger(args),
    )


def _stream_store(spark: SparkSession, args: Args) -> StreamingQuery:
    return store.start_store_messages(
        _messages(spark, args), args.out, args.boxes, args.rejects, args.checkpoint,
        **_trigger(args),
    )


def _stream_minutes(spark: SparkSession, args: Args) -> StreamingQuery:
    records = store.good_detections(store.check_detections(_messages(spark, args)))
    return stats.start_statistics(
        store.to_events(records), args.out, args.checkpoint, args.delay, **_trigger(args)
    )


STREAMS: dict[str, Callable[[SparkSession, Args], StreamingQuery]] = {
    "stream-ingest": _stream_ingest,
    "stream-detect": _stream_detect,
    "stream-store": _stream_store,
    "stream-minutes": _stream_minutes,
}

JOBS: dict[str, Job] = {
    "clean-comments": _clean_comments,
    "clean-lines": _clean_lines,
    "word-frequency": _word_frequency,
    "categories": lambda s, a: text.count_by(_reviews(s, a), "category"),
    "aspects": lambda s, a: text.count_by(_reviews(s, a), "aspect"),
    "aspect-sentiment": lambda s, a: text.aspect_sentiment(_reviews(s, a)),
    "aspect-extremes": lambda s, a: text.aspect_extremes(_reviews(s, a)),
    "top-words-by-sentiment": _top_words("category", "sentiment"),
    "top-words": _top_words("category"),
    "items": _rated_items,
    "top-item": _top_item,
    "labels": _rated_labels,
    "genders": _rated_by("gender"),
    "ages": _rated_by("age_band"),
    "occupations": _rated_occupations,
    "years": _rated_years,
    "totals": lambda s, a: sales.distinct_totals(
        _orders(s, a), _customers(s, a), _order_items(s, a)
    ),
    "countries": lambda s, a: sales.orders_by_country(_orders(s, a), _customers(s, a)),
    "months": lambda s, a: sales.orders_by_month(_orders(s, a)),
    "score-average": lambda s, a: sales.score_average(_valid_reviews(s, a)),
    "scores": lambda s, a: sales.score_histogram(_valid_reviews(s, a)),
    "revenue": _revenue,
    "products": lambda s, a: sales.product_sales(_order_items(s, a), _valid_reviews(s, a)),
    "delivery": lambda s, a: sales.delivery_difference(_orders(s, a), _order_items(s, a)),
    "segments": _segments,
    "sellers": lambda s, a: sales.seller_rank(_order_items(s, a)),
    "summary": lambda s, a: frames.summary(_events(s, a), a.camera),
    "timeseries": lambda s, a: frames.newest_timeseries(_newest(s, a), a.interval, a.limit, a.camera),
    "minutes": lambda s, a: frames.by_minute(_events(s, a)),
    "recent": lambda s, a: frames.newest_recent(_newest(s, a), a.limit, a.camera),
    "boxes": _boxes,
}

def parse(argv: Sequence[str] | None) -> Args:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=sorted({**JOBS, **STREAMS}))
    parser.add_argument("--out", required=True)
    parser.add_argument("--format", choices=("tsv", "csv", "parquet", "report"), default="tsv")
    for name in ("reviews", "ratings", "items", "users", "occupations"):
        parser.add_argument(f"--{name}", nargs="+")
    for name in ("stopwords", "orders", "customers", "order-items", "products", "order-reviews"):
        parser.add_argument(f"--{name}")
    for name in ("events", "boxes", "camera", "frame"):
        parser.add_argument(f"--{name}")
    for name in ("inbox", "rejects", "checkpoint", "every"):
        parser.add_argument(f"--{name}")
    parser.add_argument("--detector", help="module:function that loads a detector")
    parser.add_argument("--list-size", type=int, help="pictures in a call, for list detectors")
    parser.add_argument("--max-files", type=int, help="files of messages in a batch")
    parser.add_argument("--delay", default="10 minutes", help="how late events may come")
    parser.add_argument("--min-count", type=int, default=text.MIN_WORD_COUNT)
    parser.add_argument("--top", type=int, default=text.TOP_WORDS)
    parser.add_argument("--min-ratings", type=int, default=ratings.MIN_RATINGS)
    parser.add_argument("--zone", default="UTC")
    parser.add_argument("--year", type=int, default=sales.REVENUE_YEAR)
    parser.add_argument("--interval", default="minute")
    parser.add_argument("--limit", type=int)
    args = parser.parse_args(argv)
    if args.limit is None:
        args.limit = frames.LATEST_EVENTS if args.job == "recent" else frames.LATEST_BUCKETS
    if args.format == "report" and args.job not in reports.LAYOUTS:
        parser.error(f"no report layout for {args.job}")
    return args


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    """Run one job with the given command line."""
    args = parse(argv)
    if args.job in STREAMS:
        STREAMS[args.job](spark, args).awaitTermination()
        return
    result = JOBS[args.job](spark, args)
    if args.format == "report":
        reports.write_report(reports.LAYOUTS[args.job].whole(result), args.out)
    elif args.format == "tsv":
        files.write_tsv(result, args.out)
    elif args.format == "csv":
        files.write_csv(result, args.out)
    else:
        files.write_parquet(result, args.out)


if __name__ == "__main__":
    import sys

    run(get_session(), sys.argv[1:])
