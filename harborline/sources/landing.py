"""Idempotent loads: each file's rows are replaced as a whole, or not at all.

Rows are written under (_load_id, _source_file).  They become visible when a row
in the load log names that load as the newest of its file; newest is the highest
commit number, no clock decides.  Every file of a delivery is judged on its own:
its head is proven before the scan, rows of another width are set aside by the
scan, and a file with any of them is recorded in ``meta/rejected_files`` and not
committed, so its earlier load stays.  The good files beside it are committed
together.  Logs are append-only; ``compact_log`` bounds what is read of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from harborline.schemas import BAD_TYPE, LOG_SCHEMA, RAW_COLUMNS, REJECTED_SCHEMA, SNAPSHOT_FILES, text_schema
from harborline.sources.discovery import Delivery

_SNAPSHOT_SCHEMA = StructType([*LOG_SCHEMA.fields, StructField("upto", LongType())])
SHOWN_CHARACTERS = 500   # of a bad line that are kept in the reject table
HEAD_READERS = 8         # heads that are looked at at a time


class SchemaMismatch(ValueError):
    """A file's columns are not those its table expects."""


@dataclass(frozen=True)
class Rejection:
    """Why a file was not loaded."""

    file_name: str
    reason: str
    expected: tuple[str, ...]
    received: tuple[str, ...]
    bad_rows: int
    first_bad_line: str | None

    def __str__(self) -> str:
        if self.reason == "columns":
            return f"schema mismatch for {self.file_name}: expected {list(self.expected)}, received {list(self.received)}"
        return (f"{self.file_name}: {self.bad_rows} malformed ({self.reason}), expected {list(self.expected)}, "
                f"the first is {self.first_bad_line!r}")


class RejectedFiles(SchemaMismatch):
    """Some files of a delivery were refused; the others are loaded."""

    def __init__(self, rejected: Sequence[Rejection]):
        super().__init__("; ".join(map(str, rejected)))
        self.rejected = list(rejected)


class LoadResult(dict):
    """Rows per committed file; ``rejected`` lists the refused ones."""

    def __init__(self, counts: dict[str, int] | None = None, rejected: Sequence[Rejection] = ()):
        super().__init__(counts or {})
        self.rejected = list(rejected)


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def csv_heads(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Column names of each file as written; a job per file that reads its first line only."""
    def head(path: str) -> list[str]:
        return spark.read.option("header", True).option("escape", '"').csv(path).columns

    with ThreadPool(HEAD_READERS) as pool:
        return dict(zip(paths, pool.map(head, paths)))


def read_text_csv(spark: SparkSession, paths: Sequence[str], columns: list[str], strict: bool = True) -> DataFrame:
    """All files in one scan, every column text; an empty field is NULL.

    A strict read proves each file's head while it is read and fails at a row with
    an extra or a missing field, such as half of a quoted line break.  Otherwise the
    caller has proven the heads, and column ``_bad`` describes such rows.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("emptyValue", "")
    fields = [f"NULLIF(`{c}`, '') AS `{c}`" for c in columns]
    if strict:
        rows = reader.schema(text_schema(columns)).option("enforceSchema", False).option("mode", "FAILFAST").csv(list(paths))
        return rows.selectExpr(*fields, "_metadata.file_name AS _source_file")
    rows = reader.schema(text_schema([*columns, "_broken"])).option("columnNameOfCorruptRecord", "_broken").csv(list(paths))
    bad = (f"CASE WHEN _broken IS NOT NULL THEN NAMED_STRUCT('block', _metadata.file_block_start, 'place', "
           f"MONOTONICALLY_INCREASING_ID(), 'reason', 'fields', 'line', LEFT(_broken, {SHOWN_CHARACTERS})) END AS _bad")
    return rows.selectExpr(*fields, "_metadata.file_name AS _source_file", bad)


def _read_or_empty(spark: SparkSession, schema, path: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], schema)
        raise


class Lake:
    """Landing tables, load log and reject table under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _raw(self, table: str) -> str:
        return f"{self.root}/raw/{table}"

    # ------------------------------------------------------------------ reading

    def log_entries(self) -> DataFrame:
        """Every load ever committed, in folders by commit number."""
        return _read_or_empty(self.spark, LOG_SCHEMA, f"{self.root}/meta/load_log")

    def _log_snapshots(self) -> DataFrame:
        return _read_or_empty(self.spark, _SNAPSHOT_SCHEMA, f"{self.root}/meta/log_snapshot")

    def last_commit(self) -> int:
        """The highest commit number; 0 before the first."""
        return self.log_entries().agg(F.max("commit_no")).first()[0] or 0

    def load_log(self, as_of: int | None = None) -> DataFrame:
        """The newest load of every file, as of a commit number or now.

        Starts from the newest compacted log at or before that commit; commits it
        covers are pruned by their folder.
        """
        snapshots, entries = self._log_snapshots(), self.log_entries()
        if as_of is not None:
            snapshots, entries = snapshots.where(F.col("upto") <= as_of), entries.where(F.col("commit_no") <= as_of)
        covered = snapshots.agg(F.max("upto")).first()[0]
        if covered is not None:
            entries = snapshots.where(F.col("upto") == covered).drop("upto").unionByName(entries.where(F.col("commit_no") > covered))
        newest = entries.groupBy("file_name", "table_name").agg(
            F.expr("MAX(STRUCT(commit_no, loaded_at, load_id, file_date, row_count)) AS n"))
        return newest.selectExpr(
            "file_name", "n.load_id", "table_name", "n.file_date", "n.loaded_at", "n.row_count", "n.commit_no")

    def rejected_files(self) -> DataFrame:
        return _read_or_empty(self.spark, REJECTED_SCHEMA, f"{self.root}/meta/rejected_files")

    def _stored(self, name: str) -> DataFrame:
        return _read_or_empty(self.spark, text_schema([*RAW_COLUMNS[name], "_load_id", "_source_file"]), self._raw(name))

    def _of_loads(self, name: str, log: DataFrame) -> DataFrame:
        """Stored rows of the loads in a log.

        The log is one row per file and both join columns are partition columns,
        so a small log prunes the folders of other loads before they are read;
        how the join runs is left to its measured size.
        """
        loads = log.where(F.col("table_name") == name).selectExpr(
            "file_name AS _source_file", "load_id AS _load_id", "loaded_at AS _ingested_at")
        return self._stored(name).join(loads, ["_source_file", "_load_id"]).select(
            *RAW_COLUMNS[name], "_source_file", "_ingested_at")

    def table(self, name: str, as_of: int | None = None) -> DataFrame:
        """Rows of the committed loads, as of a commit number or now."""
        return self._of_loads(name, self.load_log(as_of))

    def changes(self, name: str, since: int, upto: int | None = None) -> tuple[DataFrame, DataFrame]:
        """(arrived, withdrawn): rows of loads that became current since a commit, and of those they replaced."""
        old, new = self.load_log(since), self.load_log(upto)
        key = ["file_name", "table_name", "load_id"]
        return (self._of_loads(name, new.join(old.select(key), key, "left_anti")),
                self._of_loads(name, old.join(new.select(key), key, "left_anti")))

    def superseded(self, name: str) -> DataFrame:
        """Loads of a table no log row points to any more; safe to remove."""
        current = self.load_log().where(F.col("table_name") == name).selectExpr(
            "file_name AS _source_file", "load_id AS _load_id")
        stored = self._stored(name).select("_source_file", "_load_id").distinct()
        return stored.join(current, ["_source_file", "_load_id"], "left_anti")

    # ------------------------------------------------------------------ writing

    def commit(self, entries: list[tuple]) -> None:
        """Make loads visible together: (file_name, load_id, table, file_date, loaded_at, rows)."""
        number = self.last_commit() + 1
        self.spark.createDataFrame([(*e, number) for e in entries], LOG_SCHEMA).coalesce(1).write.mode("append").partitionBy(
            "commit_no").parquet(f"{self.root}/meta/load_log")

    def compact_log(self) -> int:
        """Write the log of now as one file, which later reads start from; returns its commit number."""
        number = self.last_commit()
        if self._log_snapshots().where(F.col("upto") == number).isEmpty():
            self.load_log(number).withColumn("upto", F.lit(number)).coalesce(1).write.mode("append").partitionBy(
                "upto").parquet(f"{self.root}/meta/log_snapshot")
        return number

    def land(self, table: str, rows: DataFrame, files: dict[str, date | None],
             refused: Sequence[Rejection] = (), strict: bool = True) -> LoadResult:
        """Write rows that carry _source_file, then commit one log row per good file.

        ``rows`` may carry ``_bad`` (see ``schemas.BAD_TYPE``); a file with such a row
        is refused like those in ``refused``.  Good files are committed together,
        also empty ones.  With ``strict`` refused files raise after that.
        """
        load_id, expected = uuid.uuid4().hex, tuple(RAW_COLUMNS[table])
        if "_bad" not in rows.columns:
            rows = rows.withColumn("_bad", F.lit(None).cast(BAD_TYPE))
        # no repartition by file: one large file stays spread over its splits
        rows.withColumn("_load_id", F.lit(load_id)).write.mode("append").partitionBy(
            "_load_id", "_source_file").parquet(self._raw(table))

        # one row per file, from the folder of this load alone
        schema = text_schema([*expected, "_source_file"]).add("_bad", BAD_TYPE)
        written = _read_or_empty(self.spark, schema, f"{self._raw(table)}/_load_id={load_id}").groupBy("_source_file").agg(
            F.count("*").alias("rows"), F.count("_bad").alias("bad"), F.min("_bad").alias("first"))
        found = {r["_source_file"]: r for r in written.collect()}
        rejected = list(refused)
        for name, r in found.items():
            if r["bad"]:
                received = tuple(r["first"]["line"].split(",")) if r["first"]["reason"] == "columns" else expected
                rejected.append(Rejection(name, r["first"]["reason"], expected, received, r["bad"], r["first"]["line"]))
        bad = {r.file_name for r in rejected}
        now = datetime.now(timezone.utc)
        counts = {name: found[name]["rows"] if name in found else 0 for name in files if name not in bad}
        if rejected:
            self.spark.createDataFrame(
                [(r.file_name, table, files.get(r.file_name), load_id, now, r.reason, list(r.expected), list(r.received),
                  r.bad_rows, r.first_bad_line) for r in rejected], REJECTED_SCHEMA,
            ).coalesce(1).write.mode("append").parquet(f"{self.root}/meta/rejected_files")
        if counts:
            self.commit([(name, load_id, table, files[name], now, n) for name, n in counts.items()])
        if rejected and strict:
            raise RejectedFiles(rejected)
        return LoadResult(counts, rejected)

    def _land_csv(self, table: str, files: dict[str, date | None], paths: Sequence[str], strict: bool) -> LoadResult:
        expected = RAW_COLUMNS[table]
        heads = csv_heads(self.spark, paths)
        refused = [Rejection(_name(p), "columns", tuple(expected), tuple(head), 1, ",".join(head))
                   for p, head in heads.items() if head != expected]
        good = [p for p, head in heads.items() if head == expected]
        if good:
            rows = read_text_csv(self.spark, good, expected, strict=False)
        else:
            rows = self.spark.createDataFrame([], text_schema([*expected, "_source_file"]))
        return self.land(table, rows, files, refused, strict)

    def load_daily(self, table: str, deliveries: Iterable[Delivery], strict: bool = True) -> LoadResult:
        """Load the delivered files of one table in a single scan; skip missing ones."""
        present = [d for d in deliveries if d.path is not None]
        if not present:
            return LoadResult()
        return self._land_csv(table, {d.file_name: d.file_date for d in present}, [d.path for d in present], strict)

    def load_frame(
        self, table: str, deliveries: Iterable[Delivery], read: Callable[[SparkSession, list[Delivery]], DataFrame],
        strict: bool = True,
    ) -> LoadResult:
        """The same for files that need a reader of their own, such as ad exports.

        The reader may mark rows in ``_bad``.  An empty file is refused: every export has a head or a document.
        """
        present = [d for d in deliveries if d.path is not None]
        if not present:
            return LoadResult()
        expected = RAW_COLUMNS[table]
        # a listing of binary files leaves out those of no bytes
        listed = self.spark.read.format("binaryFile").load([d.path for d in present]).select("path")
        filled = {_name(r.path) for r in listed.collect()}
        readable = [d for d in present if d.file_name in filled]
        refused = [Rejection(d.file_name, "columns", tuple(expected), (), 1, None) for d in present if d.file_name not in filled]
        if readable:
            rows = read(self.spark, readable)
        else:
            rows = self.spark.createDataFrame([], text_schema([*expected, "_source_file"]))
        received = [c for c in rows.columns if c != "_bad"]
        if received != [*expected, "_source_file"]:
            raise SchemaMismatch(f"schema mismatch for {table}: expected {[*expected, '_source_file']}, received {received}")
        return self.land(table, rows, {d.file_name: d.file_date for d in present}, refused, strict)

    def load_snapshot(self, table: str, folder: str) -> int:
        """Full replace of a dimension; a missing file is an error."""
        name = SNAPSHOT_FILES[table]
        path = f"{folder.rstrip('/')}/{name}"
        try:
            return self._land_csv(table, {name: None}, [path], strict=True)[name]
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                raise FileNotFoundError(f"missing snapshot file: {path}") from error
            raise
