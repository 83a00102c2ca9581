"""Command line jobs, for `spark-submit run.py <job> …`. The master comes from spark-submit."""

import argparse

from tidemark import plans, sources, streaming
from tidemark.fixed import TOPIC
from tidemark.plans import documents
from tidemark.session import get_session, remove_work_folders, work_folder


def analyses(spark, args):
    """All six analyses as documents, printed or written as JSON below --out."""
    raw = sources.read_videos(spark, args.videos)
    # Text is parsed once; the analyses then scan pruned parquet columns.
    videos = sources.write_table(plans.normalize_videos(raw), work_folder(spark, "videos"))
    categories = sources.read_categories(spark, args.categories)
    results = {
        "top_trending_videos": documents.video_documents(videos),
        "top_week_categories": documents.week_documents(videos, categories),
        "top_tags_monthly": documents.month_documents(videos, args.dedupe),
        "top_channels": documents.channel_documents(videos),
        "top_trending_channels": documents.trending_channel_documents(videos),
        "top_category_videos": documents.category_documents(videos, categories),
    }
    for name, result in results.items():
        if args.out:
            result.write.json(f"{args.out}/{name}")
        else:
            print(f"\n{name.replace('_', ' ').capitalize()}:")
            result.printSchema()
            result.show()


def profile(spark, args):
    """Schema, first rows and row count of a transaction file; with --out also a table and its profile."""
    rows = sources.read_transactions(spark, args.transactions)
    plans.preview(rows)
    if args.out:
        plans.write_profiled(rows, f"{args.out}/table").coalesce(1).write.json(f"{args.out}/profile")


def replay(spark, args):
    """Send tweets as messages at the fixed pace; stops when all have been sent.

    Batches are logged, and records that cannot be sent set aside, below the progress folder.
    """
    topic = streaming.topic_sender(lambda messages: sources.message_writer(messages, args.servers, args.topic))
    send = streaming.acknowledged(topic, f"{args.progress}/delivery")
    streaming.replay_paced(spark, sources.read_tweets(spark, args.tweets), args.progress, send).wait()


def minutes(spark, args):
    """Write the messages of a topic to one folder of CSV files per minute below `out/raw`, until stopped.

    Positions of the committed batches go to the progress folder. `compact` merges the files of closed minutes.
    """
    messages = streaming.decode_messages(
        sources.message_reader(
            spark, args.servers, args.topic, starting_offsets=args.start, max_offsets_per_trigger=args.batch
        )
    )
    spark.streams.addListener(streaming.PositionLog(spark, f"{args.progress}/positions", args.topic))
    streaming.write_minute_files(messages, f"{args.out}/raw", f"{args.progress}/stream", name=args.topic).awaitTermination()


def compact(spark, args):
    """Merge the files of all minutes before a minute key (`2024_01_31_23_59_00`) to one file each."""
    print(f"{streaming.compact_minutes(spark, args.out, args.before):,} minutes merged")


def parser():
    top = argparse.ArgumentParser(prog="run.py")
    jobs = top.add_subparsers(dest="job", required=True)

    def add(job, *required, **optional):
        sub = jobs.add_parser(job.__name__, help=job.__doc__)
        sub.set_defaults(run=job)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        for name, default in optional.items():
            kind = int if name == "batch" else str
            sub.add_argument(f"--{name.replace('_', '-')}", default=default, type=kind)

    add(analyses, "videos", "categories", out=None, dedupe="day")
    add(profile, "transactions", out=None)
    add(replay, "tweets", "servers", "progress", topic=TOPIC)
    add(minutes, "servers", "out", "progress", topic=TOPIC, start="latest", batch=None)
    add(compact, "out", "before")
    return top


def main(arguments=None):
    args = parser().parse_args(arguments)
    spark = get_session(f"tidemark {args.job}")
    try:
        args.run(spark, args)
    finally:
        remove_work_folders(spark)
