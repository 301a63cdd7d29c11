"""A mailbox as a Spark data source: `spark.read.format("mailbox")`.

The mailbox is a parquet folder with one day=yyyy-MM-dd folder per day. The files of the wanted
days are dealt to at most about PARTS input partitions, following days to one where there are more,
so the days are read side by side. A file of LARGE bytes or more has one for each of its row
groups, so a day with far more mail than the others is split as well; only such files are opened
to plan a scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FIELDS = ("id", "received_at", "subject", "body")
PARTS = 512
LARGE = 64 * 1024 * 1024


@dataclass
class DayPart(InputPartition):
    """`day` is that of the first file; without a row group the files are read whole."""

    day: str
    files: list[str]
    row_group: int | None = None


class MailboxSource(DataSource):
    """Options: path, from_date (yyyy-MM-dd, not included), days."""

    @classmethod
    def name(cls):
        return "mailbox"

    def schema(self):
        return "id string, received_at timestamp, subject string, body string"

    def reader(self, schema):
        return MailboxReader(self.options)


class MailboxReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.from_date = dt.date.fromisoformat(options["from_date"])
        self.days = int(options.get("days", "7"))

    def partitions(self):
        import pyarrow.fs as fs
        import pyarrow.parquet as pq

        system, root = _locate(self.path)
        there = {
            info.base_name: info.path
            for info in system.get_file_info(fs.FileSelector(root, allow_not_found=True))
        }
        small, found = [], []
        for back in range(1, self.days + 1):
            day = (self.from_date - dt.timedelta(days=back)).isoformat()
            folder = there.get(f"day={day}")
            if folder is None:
                continue
            for info in system.get_file_info(fs.FileSelector(folder, recursive=True)):
                names = info.path[len(folder) :].strip("/").split("/")
                if not info.is_file or any(name[0] in "._" for name in names):
                    continue
                if info.size < LARGE:
                    small.append((day, info.path))
                    continue
                with system.open_input_file(info.path) as opened:
                    groups = pq.ParquetFile(opened).num_row_groups
                found += [DayPart(day, [info.path], group) for group in range(groups)]
        step = -(-len(small) // PARTS)
        for first in range(0, len(small), max(1, step)):
            some = small[first : first + step]
            found.append(DayPart(some[0][0], [path for _, path in some]))
        return found

    def read(self, partition):
        import pyarrow as pa
        import pyarrow.parquet as pq

        if partition is None:  # no day had any file
            return
        system, _ = _locate(self.path)
        groups = None if partition.row_group is None else [partition.row_group]
        at = FIELDS.index("received_at")
        for path in partition.files:
            with system.open_input_file(path) as opened:
                for batch in pq.ParquetFile(opened).iter_batches(
                    row_groups=groups, columns=list(FIELDS)
                ):
                    batch = batch.select(list(FIELDS))
                    instants = batch.column(at).cast(pa.timestamp("us", "UTC"))
                    yield batch.set_column(at, "received_at", instants)


def _locate(path: str):
    import pyarrow.fs as fs

    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def write_mailbox(messages: DataFrame, path: str) -> None:
    """Messages in the layout the source reads. Rebalancing gathers small days into few
    files and splits large ones."""
    dated = messages.select(*FIELDS, F.to_date("received_at").alias("day"))
    dated.hint("rebalance", "day").write.mode("append").partitionBy("day").parquet(path)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MailboxSource)
