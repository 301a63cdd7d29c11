"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import statistics
import sys
import tempfile
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from mailspark.queries import QUERIES  # noqa: E402
from mailspark.queries.learning import PARAMS  # noqa: E402
from mailspark.session import build_session  # noqa: E402

HEADLINES = (
    "fn07_clean_text",
    "fn03_html_text",
    "fn03_html_text_native",
    "fn14_decode_payload",
    "fn14_decode_payload_strict",
    "ml01_embed",
    "run01_triage_slice",
    "win01_chunk_ids",
    "win01_chunk_per_mailbox",
    "win02_first_per_group",
    "src04_batched_fetch_retry",
    "snk03_insert_if_absent",
    "snk09_move_to_trash",
    "snk10_purge",
    "agg06_masked_mean",
    "ml02_train",
    "ml07_score_messages",
    "ml05_one_round",
    "str03_arrivals_per_day",
    "str04_unique_ids",
)

# a headline that takes longer, all its runs together, is cut off and named in the result
HEADLINE_SECONDS = 300


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            # cut files so that every core reads
            "spark.sql.files.maxPartitionBytes": str(2 * 1024 * 1024),
            "spark.sql.files.openCostInBytes": "65536",
        },
    )
    spark.sparkContext.setLogLevel("OFF")

    # The given tables are files of one row group, which Spark cannot split. Tables of this
    # library's size have many, so the text tables are laid out in files first, untimed.
    laid_out = tempfile.mkdtemp(prefix="mailspark-bench-")
    for source in sorted(os.listdir(sf_dir)):
        target = os.path.join(laid_out, source)
        if source in ("documents.parquet", "pages.parquet"):
            files = 2 * int(cpus)
            spark.read.parquet(f"{sf_dir}/{source}").repartition(files).write.parquet(target)
        else:
            os.symlink(os.path.join(os.path.abspath(sf_dir), source), target)

    def run(name):
        start = time.perf_counter()
        QUERIES[name](spark, laid_out).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def headline(name):
        """Seconds, or None where the query fails or a run of it is cut off."""
        group = f"bench-{name}"
        spark.sparkContext.setJobGroup(group, name, interruptOnCancel=True)
        timer = threading.Timer(
            HEADLINE_SECONDS, lambda: spark.sparkContext.cancelJobGroup(group)
        )
        timer.start()
        try:
            run(name)  # warm-up: class loading, code generation, worker start
            return round(statistics.median(run(name) for _ in range(repeats)), 3)
        except Exception as e:
            print(f"{name}: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr, flush=True)
            return None
        finally:
            timer.cancel()

    took, failed = {}, []
    for name in HEADLINES:
        seconds = headline(name)
        if seconds is None:
            failed.append(name)
            continue
        took[name] = seconds
        print(f"{name}: {took[name]}", file=sys.stderr, flush=True)
    messages = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "messages": messages,
        "classifier_rounds": PARAMS.rounds,
        "layout": f"documents and pages in {2 * int(cpus)} files",
        "mails_per_minute": {
            q: round(60 * messages / took[q])
            for q in ("fn07_clean_text", "fn14_decode_payload", "ml01_embed", "ml07_score_messages")
            if q in took
        },
        "failed": failed,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
