"""Click rows: raw records from JSON lines, de-duplication and the flat table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import from_date_text, from_epoch_millis
from ..functions.jsontext import member_quoted, parsed
from ..operators.project import project

KEY = ("id", "year")

# Output column, JSON member and type of the flat click table, in output order.
MEMBERS = (
    ("id", "Id", "text"),
    ("metaschema", "Meta:schema", "text"),
    ("burnin", "BurnIn", "flag"),
    ("device", "Device", "text"),
    ("passid", "PassId", "int"),
    ("siteid", "SiteId", "int"),
    ("zoneid", "ZoneId", "int"),
    ("brandid", "BrandId", "int"),
    ("adtypeid", "AdTypeId", "int"),
    ("location", "Location", "text"),
    ("ratetype", "RateType", "int"),
    ("channelid", "ChannelId", "int"),
    ("created_on", "CreatedOn", "date text"),
    ("networkid", "NetworkId", "int"),
    ("isnotrack", "IsNoTrack", "flag"),
    ("campaignid", "CampaignId", "int"),
    ("clickcount", "ClickCount", "int"),
    ("creativeid", "CreativeId", "int"),
    ("datacenter", "DataCenter", "flag"),
    ("decisionid", "DecisionId", "text"),
    ("priorityid", "PriorityId", "int"),
    ("timezoneid", "TimeZoneId", "text"),
    ("decisionidx", "DecisionIdx", "int"),
    ("servedbyasg", "ServedByAsg", "text"),
    ("servedbypid", "ServedByPid", "int"),
    ("impressionid", "ImpressionId", "text"),
    ("placementname", "PlacementName", "text"),
    ("creativepassid", "CreativePassId", "int"),
    ("eventcreatedon", "EventCreatedOn", "millis"),
    ("firstchannelid", "FirstChannelId", "int"),
    ("impressioncreatedon", "ImpressionCreatedOn", "millis"),
    ("keywords", "Keywords", "text"),
    ("price", "Price", "text"),
    ("url", "Url", "text"),
)
USER_MEMBERS = (
    ("user_key", "Key", "text"),
    ("user_is_new", "IsNew", "flag"),
    ("user_type", "Type", "int"),
)
FLAT_COLUMNS = (
    *(m[0] for m in MEMBERS),
    *(m[0] for m in USER_MEMBERS),
    "file_name",
    "last_modified_date",
    "year",
)


def _flag(text: Column) -> Column:
    """Boolean text; 'on' and 'off' count as well."""
    word = F.lower(text)
    return F.when(word == "on", F.lit(True)).when(word == "off", F.lit(False)).otherwise(
        F.when(~word.isin("on", "off"), text).cast("boolean")
    )


_TYPED = {
    "text": lambda text: text,
    "int": lambda text: text.cast("int"),
    "flag": _flag,
    "date text": from_date_text,
    "millis": lambda text: from_epoch_millis(text.cast("bigint")),
}


def click_rows(lines: DataFrame) -> DataFrame:
    """Raw click records from JSON lines (`value`, `file_name`, `last_modified_date`).

    The id is the JSON text of the member, quotes included, and the year is that of the file's
    modification. A line that is not JSON stops the job.
    """
    return lines.select(
        member_quoted(parsed(F.col("value")), "Id", F.col("value")).alias("id"),
        F.col("value").alias("data"),
        "file_name",
        "last_modified_date",
        F.year("last_modified_date").alias("year"),
    )


def first_clicks(clicks: DataFrame) -> DataFrame:
    """One row per (id, year): the earliest by file time, then file name, then text.

    The columns that rank a row are the row, so it is held and moved once.
    """
    rank = ["last_modified_date", "file_name", "data"]
    row = F.struct(*rank, *[c for c in clicks.columns if c not in (*KEY, *rank)])
    kept = clicks.groupBy(*KEY).agg(F.min(row).alias("_row"))
    return kept.select(*KEY, "_row.*").select(*clicks.columns)


def unseen_clicks(clicks: DataFrame, stored: DataFrame) -> DataFrame:
    """Distinct new clicks whose (id, year) is not stored yet.

    Both sides are unique on the key, so no key is hot, and the de-duplicated side is already
    partitioned by it. Only the key columns of the stored table are read.
    """
    fresh = first_clicks(clicks)
    return fresh.join(stored.select(*KEY), list(KEY), "left_anti").select(*clicks.columns)


def unseen_clicks_by_bucket(clicks: DataFrame, stored: DataFrame, buckets: int) -> DataFrame:
    """The same against a table bucketed by id: the new rows are moved to its buckets and the stored
    keys are compared where they lie.

    The year is compared as a difference, so that the join key is the id alone, as in the bucketing.
    An id has at most one row per year on either side.
    """
    fresh = first_clicks(clicks).repartition(buckets, "id")
    keys = stored.select(F.col("id").alias("_id"), F.col("year").alias("_year"))
    same = (F.col("id") == F.col("_id")) & (F.col("year") - F.col("_year") == 0)
    return fresh.join(keys, same, "left_anti").select(*clicks.columns)


def flat_clicks(clicks: DataFrame) -> DataFrame:
    """The 40-column click table. Each record is parsed once, every member as text."""
    fields = ", ".join(f"`{member}` STRING" for _, member, _ in MEMBERS)
    user = ", ".join(f"`{member}` STRING" for _, member, _ in USER_MEMBERS)
    schema = f"{fields}, `User` STRUCT<{user}>"
    rows = clicks.select(
        F.from_json("data", schema, {"mode": "FAILFAST"}).alias("_click"),
        "file_name",
        "last_modified_date",
        "year",
    )
    record = F.col("_click")
    expressions = {name: _TYPED[kind](record[member]) for name, member, kind in MEMBERS}
    expressions |= {name: _TYPED[kind](record["User"][m]) for name, m, kind in USER_MEMBERS}
    return project(rows, FLAT_COLUMNS, expressions)


def high_water_mark(clicks: DataFrame) -> DataFrame:
    """Latest file modification; null for an empty table."""
    return clicks.agg(F.max("last_modified_date").alias("last_date"))


def high_water_marks(tables: dict[str, DataFrame]) -> DataFrame:
    """The same for several tables at once: one row per table, null where it is empty.

    Only the date column of each table is read, and each is reduced before the rows are combined.
    """
    marks = [
        table.agg(F.max("last_modified_date").alias("last_date")).select(
            F.lit(name).alias("table_name"), "last_date"
        )
        for name, table in tables.items()
    ]
    combined = marks[0]
    for mark in marks[1:]:
        combined = combined.unionByName(mark)
    return combined
