"""The daily-file load as a stream over a delivery folder.

The stream only finds files; each micro-batch hands its paths to the batch load,
so heads, broken rows and rejects are judged by the same code, and a retried
batch replaces its own files.  The file source remembers paths: a file that is
sent again under its name is a matter for ``Lake.load_daily``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from harborline.sources.discovery import DAILY_PATTERNS, Delivery
from harborline.sources.landing import Lake


def _day(name: str, before: str, after: str) -> date | None:
    try:
        return date.fromisoformat(name[len(before): len(name) - len(after)])
    except ValueError:
        return None  # another file that merely looks similar


def land_new_files(
    lake: Lake, table: str, folder: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Land every file of ``table`` that is new in ``folder``, then stop.

    Refused files are recorded in the reject table and do not stop the stream.
    """
    before, after = DAILY_PATTERNS[table].split("{date}")
    found = (
        lake.spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", f"{before}*{after}").option("maxFilesPerTrigger", files_per_batch)
        .load(folder).select("path")  # contents are not read here
    )

    def land(batch: DataFrame, _: int) -> None:
        deliveries = []
        for row in batch.collect():  # files of this batch
            name = row.path.rsplit("/", 1)[-1]
            day = _day(name, before, after)
            if day is not None:
                deliveries.append(Delivery(table, name, day, row.path))
        lake.load_daily(table, deliveries, strict=False)

    return (
        found.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
