"""Readers for the ad platforms' export formats.

A reader only brings structure into the common columns; values stay text, as
exported, for cleaning to judge.  Each takes all files of its platform and reads
them in one scan.  What cannot be read does not stop the others: column ``_bad``
says where and why (see ``schemas.BAD_TYPE``), and the load refuses that file.

An export is one day of one platform, so a file is one record of the scan; that
gives every line its place, whatever it says.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from harborline.functions.text import quote
from harborline.schemas import RAW_COLUMNS
from harborline.sources.discovery import Delivery

_UNIFIED = RAW_COLUMNS["ad_performance"]
# The columns of a Google report and of a TikTok export.
GOOGLE_COLUMNS = ("Campaign", "Cost", "Impr.", "Clicks", "Conv.", "Day")
TIKTOK_COLUMNS = ("stat_date", "campaign_id", "campaign_name", "cost_usd", "impressions", "clicks", "conversions")
GOOGLE_PREAMBLE = 2


def _text_fields(*names: str) -> list[StructField]:
    return [StructField(n, StringType()) for n in names]


_AD = StructType(_text_fields("ad_id", "spend", "impressions", "clicks", "conversions"))
_ADSET = StructType([*_text_fields("adset_id", "adset_name"), StructField("ads", ArrayType(_AD))])
_CAMPAIGN = StructType([*_text_fields("campaign_id", "campaign_name"), StructField("adsets", ArrayType(_ADSET))])
_FACEBOOK = StructType([
    *_text_fields("account", "date_start", "timezone"), StructField("campaigns", ArrayType(_CAMPAIGN)), *_text_fields("_broken"),
])


def _bad(condition: str, place: str, reason: str, line: str) -> str:
    return (f"CASE WHEN {condition} THEN NAMED_STRUCT('block', 0L, 'place', {place}, 'reason', {reason}, "
            f"'line', LEFT({line}, 500)) END AS _bad")


def read_facebook(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Nested JSON, one document per file, flattened to one row per ad; USD.

    Numbers are read as the text they were written in.  An explicit null becomes
    the text ``None``: delivered but no number, which cleaning flags.  A truncated
    document is bad as a whole.
    """
    documents = spark.read.schema(_FACEBOOK).option("multiLine", True).option("columnNameOfCorruptRecord", "_broken").json(list(paths))
    ads = (
        documents.selectExpr("date_start", "EXPLODE_OUTER(campaigns) AS c", "_metadata.file_name AS _source_file", "_broken")
        .selectExpr("date_start", "c.campaign_id", "c.campaign_name", "EXPLODE_OUTER(c.adsets) AS s", "_source_file", "_broken")
        .selectExpr("date_start", "campaign_id", "campaign_name", "EXPLODE_OUTER(s.ads) AS a", "_source_file", "_broken")
    ).where("a IS NOT NULL OR _broken IS NOT NULL")
    return ads.selectExpr(
        "date_start AS report_date", "'facebook' AS platform", "campaign_id", "a.ad_id AS ad_id", "campaign_name",
        "COALESCE(a.spend, 'None') AS spend", "'USD' AS currency",
        "COALESCE(a.impressions, 'None') AS impressions", "COALESCE(a.clicks, 'None') AS clicks",
        "COALESCE(a.conversions, 'None') AS conversions", "_source_file",
        _bad("_broken IS NOT NULL", "0L", "'document'", "_broken"),
    )


def _report_rows(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], preamble: int) -> DataFrame:
    """(fields, _source_file, place, line, state) of every line after the head, which stands behind ``preamble`` lines.

    fields: the values in the order of ``columns``, found by the names in the file's
    own head.  state: NULL, ``columns`` for the one row of a file whose head has other
    names, ``fields`` for a line of another width.  Blank lines do not count.
    """
    names = [f"c{i}" for i in range(len(columns))]
    schema = ", ".join([*(f"{n} STRING" for n in names), "_broken STRING"])

    def parsed(line: str) -> str:
        return (f"FROM_CSV({line}, '{schema}', MAP('mode', 'PERMISSIVE', 'columnNameOfCorruptRecord', '_broken', 'escape', '\"'))")

    wanted = "ARRAY(" + ", ".join(quote(c) for c in sorted(columns)) + ")"
    held = f"ARRAY({', '.join(f'r.{n}' for n in names)})"
    files = spark.read.text(list(paths), wholetext=True).selectExpr(
        "_metadata.file_name AS _source_file", r"FILTER(SPLIT(value, '\r\n|\n|\r'), x -> TRIM(x) != '') AS lines")
    headed = files.selectExpr(
        "_source_file", f"GET(lines, {preamble}) AS head",
        f"SLICE(lines, {preamble + 2}, GREATEST(SIZE(lines) - {preamble + 1}, 0)) AS lines",
    ).selectExpr("*", f"{parsed('head')} AS r").selectExpr(
        "_source_file", "head", "lines", f"TRANSFORM({held}, x -> TRIM(x)) AS names", "r._broken IS NULL AS even"
    ).selectExpr("*", f"COALESCE(even AND SORT_ARRAY(names) = {wanted}, FALSE) AS fits")
    lines = headed.selectExpr(
        "_source_file", "names", "fits",
        "POSEXPLODE(CASE WHEN fits THEN lines ELSE ARRAY(COALESCE(head, '')) END) AS (place, line)")
    rows = lines.selectExpr("*", f"{parsed('line')} AS r").selectExpr(
        "_source_file", "CAST(place AS BIGINT) AS place", "line", "names", f"{held} AS given",
        "CASE WHEN NOT fits THEN 'columns' WHEN r._broken IS NOT NULL OR r IS NULL THEN 'fields' END AS state")
    by_name = ", ".join(f"NULLIF(GET(given, CAST(ARRAY_POSITION(names, {quote(c)}) AS INT) - 1), '')" for c in columns)
    return rows.selectExpr(f"ARRAY({by_name}) AS fields", "_source_file", "place", "line", "state")


def _dated(rows: DataFrame, at: int, pattern: str) -> DataFrame:
    """Add report_date; a line without a readable day is bad, too."""
    return rows.selectExpr("*", f"CAST(TRY_TO_DATE(fields[{at}], '{pattern}') AS STRING) AS report_date").selectExpr(
        "*", _bad("state IS NOT NULL OR report_date IS NULL", "place", "COALESCE(state, 'day')", "line"))


def read_google(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Two lines of report metadata, a head, DD/MM/YYYY dates, THB, no ids; columns in any order."""
    campaign, cost, impressions, clicks, conversions, day = range(len(GOOGLE_COLUMNS))
    return _dated(_report_rows(spark, paths, GOOGLE_COLUMNS, GOOGLE_PREAMBLE), day, "dd/MM/yyyy").selectExpr(
        "report_date", "'google' AS platform", "CAST(NULL AS STRING) AS campaign_id", "CAST(NULL AS STRING) AS ad_id",
        f"fields[{campaign}] AS campaign_name", f"fields[{cost}] AS spend", "'THB' AS currency",
        f"fields[{impressions}] AS impressions", f"fields[{clicks}] AS clicks", f"fields[{conversions}] AS conversions",
        "_source_file", "_bad",
    )


def read_tiktok(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A head with columns in any order, YYYYMMDD dates, USD."""
    day, campaign_id, campaign, cost, impressions, clicks, conversions = range(len(TIKTOK_COLUMNS))
    return _dated(_report_rows(spark, paths, TIKTOK_COLUMNS, 0), day, "yyyyMMdd").selectExpr(
        "report_date", "'tiktok' AS platform", f"fields[{campaign_id}] AS campaign_id", "CAST(NULL AS STRING) AS ad_id",
        f"fields[{campaign}] AS campaign_name", f"fields[{cost}] AS spend", "'USD' AS currency",
        f"fields[{impressions}] AS impressions", f"fields[{clicks}] AS clicks", f"fields[{conversions}] AS conversions",
        "_source_file", "_bad",
    )


READERS = {"facebook": read_facebook, "google": read_google, "tiktok": read_tiktok}


def platform_of(file_name: str) -> str:
    for platform in READERS:
        if file_name.startswith(f"{platform}_ads_"):
            return platform
    raise ValueError(f"no ad platform delivers files like {file_name}")


def read_deliveries(spark: SparkSession, deliveries: Sequence[Delivery]) -> DataFrame:
    """All ad files, whatever their platform, in the common columns."""
    by_platform: dict[str, list[str]] = {}
    for d in deliveries:
        by_platform.setdefault(platform_of(d.file_name), []).append(d.path)
    result = None
    for platform, paths in by_platform.items():
        part = READERS[platform](spark, paths).select(*_UNIFIED, "_source_file", "_bad")
        result = part if result is None else result.unionByName(part)
    return result
