"""Tables that change together: versions, and a manifest that switches them at once.

A build writes its tables to folders of its own and publishes by writing one
manifest that lists, for every table, the folders of its current parts.  Readers
take the manifest of the highest number once and read all tables through it, so
nobody sees two builds mixed, and a build that fails or breaks a check leaves no
trace but unlisted folders.  A part is a table as a whole or, with ``by``, one
value of a column; an incremental build lists new folders for the parts it
touched and the old ones for the rest.

Manifests are read on the driver: one row per part, days or buckets, never per
row.  Old folders are not deleted here; a part no manifest in use lists can go.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from harborline.session import TIGHT, released_shuffles

MANIFEST_SCHEMA = StructType([
    StructField("table_name", StringType()), StructField("part", StringType()), StructField("path", StringType()),
    StructField("rows", LongType()), StructField("schema", StringType()), StructField("by", StringType()),
    StructField("properties", StringType()), StructField("number", LongType()),
])
WHOLE, NO_VALUE, PART = "all", "none", "_part"


class PublishConflict(RuntimeError):
    """Another build was published since this one began."""


@dataclass(frozen=True)
class Part:
    path: str
    rows: int


@dataclass(frozen=True)
class Listing:
    """A table in a manifest: its schema, the column its parts are cut by, and their folders."""

    schema: StructType
    by: str | None
    parts: Mapping[str, Part]

    def read(self, spark: SparkSession, parts: Iterable[str] | None = None) -> DataFrame:
        wanted = self.parts if parts is None else {p: self.parts[p] for p in sorted(set(parts)) if p in self.parts}
        paths = [p.path for p in wanted.values()]
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)


@dataclass(frozen=True)
class Snapshot:
    """All published tables at one manifest number; 0 is the empty beginning."""

    spark: SparkSession
    number: int = 0
    tables: Mapping[str, Listing] = field(default_factory=dict)
    properties: Mapping[str, str] = field(default_factory=dict)

    def table(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """The table, or those of its parts that exist."""
        return self.tables[name].read(self.spark, parts)

    def __contains__(self, name: str) -> bool:
        return name in self.tables


class Published:
    """Tables under one root.

    A part is named by the text of its column's value or, with ``prefixes``, by the
    first characters of it: {"business_date": 7} keeps a part per month.  All
    builds of a root must use the same.
    """

    def __init__(self, spark: SparkSession, root: str, prefixes: Mapping[str, int] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefixes = dict(prefixes or {})

    def part_of(self, column: str) -> Column:
        text = F.col(column).cast("string")
        return F.coalesce(F.left(text, F.lit(self.prefixes[column])) if column in self.prefixes else text, F.lit(NO_VALUE))

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return None
            raise

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The tables of the newest manifest, or of an earlier one."""
        manifests = self._manifests()
        if manifests is None:
            return Snapshot(self.spark)
        last = number if number is not None else manifests.agg(F.max("number")).first()[0]
        if last is None:
            return Snapshot(self.spark)
        listings: dict[str, tuple] = {}
        properties: dict[str, str] = {}
        for row in manifests.where(F.col("number") == last).collect():  # one row per part
            properties = json.loads(row.properties)
            schema, by, parts = listings.setdefault(row.table_name, (row.schema, row.by, {}))
            if row.path is not None:
                parts[row.part] = Part(row.path, row.rows)
        return Snapshot(self.spark, last, {
            name: Listing(StructType.fromJson(json.loads(schema)), by, parts) for name, (schema, by, parts) in listings.items()
        }, properties)

    def begin(self) -> Build:
        return Build(self)


class Build:
    """New versions of some tables on top of the snapshot it began with."""

    def __init__(self, store: Published):
        self.store = store
        self.base = store.snapshot()
        self.id = uuid.uuid4().hex
        self.tables: dict[str, Listing] = dict(self.base.tables)
        self.counted: dict[str, dict[str, int]] = {}

    def _written(self, name: str, rows: DataFrame, by: str | None, hidden: bool, metrics: Mapping[str, Column] | None,
                 gathered: bool = False) -> Listing:
        path = f"{self.store.root}/data/{name}/{self.id}-{uuid.uuid4().hex[:8]}"
        if metrics:
            # counts ride on the write instead of a second pass
            observation = Observation()
            observed = rows.observe(observation, *[c.alias(m) for m, c in metrics.items()])
        else:
            observed = rows
        if by is None:
            with released_shuffles(self.store.spark):
                observed.write.option("compression", TIGHT).parquet(path)
            parts = {WHOLE: Part(path, self.store.spark.read.schema(rows.schema).parquet(path).count())}
        else:
            cut = observed.withColumn(PART, self.store.part_of(by))
            rows = rows.drop(by) if hidden else rows
            cut = cut.select(PART, *rows.columns)
            if not gathered:
                # one task per part where it is small; AQE splits a part that holds a third of all rows
                cut = cut.hint("rebalance", F.col(PART))
            with released_shuffles(self.store.spark):
                cut.write.partitionBy(PART).option("compression", TIGHT).parquet(path)
            found = self.store.spark.read.schema(StructType([StructField(PART, StringType())])).option("basePath", path).parquet(path)
            parts = {r[0]: Part(f"{path}/{PART}={r[0]}", r[1]) for r in found.groupBy(PART).count().collect()}
        listing = Listing(rows.schema, by, parts)
        if metrics:
            try:
                found = observation.get
            except Py4JJavaError:
                # no metrics come back from a plan that turned out empty and was cut away
                found = listing.read(self.store.spark).agg(*[c.alias(m) for m, c in metrics.items()]).first().asDict()
            self.counted.setdefault(name, {}).update(found)
        return listing

    def replace(self, name: str, rows: DataFrame, by: str | None = None, hidden: bool = False,
                metrics: Mapping[str, Column] | None = None, gathered: bool = False) -> DataFrame:
        """A new version of the whole table; returns the stored copy.

        ``hidden`` keeps column ``by`` out of the stored rows.  ``metrics`` are
        aggregates over the rows that are computed while they are written; see ``counted``.
        ``gathered`` rows come row by row from a table with the same parts and are written without a shuffle.
        """
        self.tables[name] = self._written(name, rows, by, hidden, metrics, gathered)
        return self.table(name)

    def replace_parts(self, name: str, rows: DataFrame, by: str, touched: Iterable[str], hidden: bool = False,
                      metrics: Mapping[str, Column] | None = None, gathered: bool = False) -> DataFrame:
        """New versions of the ``touched`` parts, which ``rows`` hold whole; a touched part without rows ends."""
        touched = set(touched)
        new = self._written(name, rows, by, hidden, metrics, gathered)
        if stray := set(new.parts) - touched:
            raise ValueError(f"{name}: rows of parts that are not touched: {sorted(stray)[:5]}")
        old = self.tables.get(name)
        kept = {p: at for p, at in old.parts.items() if p not in touched} if old else {}
        self.tables[name] = Listing(new.schema, by, {**kept, **new.parts})
        return self.table(name)

    def table(self, name: str, parts: Iterable[str] | None = None) -> DataFrame:
        """As this build leaves it."""
        return self.tables[name].read(self.store.spark, parts)

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def publish(self, **properties: str) -> Snapshot:
        """Switch all tables at once.  Properties are carried on from manifest to manifest."""
        if self.store.snapshot().number != self.base.number:
            raise PublishConflict(f"the tables changed since number {self.base.number}")
        number, text = self.base.number + 1, json.dumps({**self.base.properties, **properties})
        rows = []
        for name, listing in self.tables.items():
            schema = listing.schema.json()
            rows += [(name, part, at.path, at.rows, schema, listing.by, text, number) for part, at in listing.parts.items()] \
                or [(name, None, None, 0, schema, listing.by, text, number)]
        frame = self.store.spark.createDataFrame(rows, MANIFEST_SCHEMA).drop("number").coalesce(1)
        try:
            frame.write.mode("error").parquet(f"{self.store.root}/manifest/number={number}")
        except AnalysisException as error:
            if "PATH_ALREADY_EXISTS" in str(error):
                raise PublishConflict(f"number {number} was published meanwhile") from error
            raise
        return self.store.snapshot(number)
