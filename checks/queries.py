"""Registered queries: each runs a library plan over whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions import calendar
from ledgerloom.operators.lookup import keep_related
from ledgerloom.operators.paging import page_after, page_at, paged
from ledgerloom.operators.reduce import pick_rows
from ledgerloom.plans import boost, clicks, events, invoices, orders, proposals, purchase_orders
from ledgerloom.plans.ratings import rating_report
from ledgerloom.plans.snapshots import SNAPSHOTS, address_lines, grouped_inventories, snapshot
from ledgerloom.schemas import BOOST_SCORES
from ledgerloom.session import work_folder
from ledgerloom.sinks.catalog import register
from ledgerloom.sinks.parquet import dataset_path, refresh_partitions, row_count, write_snapshot
from ledgerloom.sinks.upsert import (
    boost_files,
    create_click_table,
    insert_new_clicks,
    insert_new_clicks_into,
    stored_clicks,
    write_boosted,
)
from ledgerloom.sinks.versions import read_version, write_full
from ledgerloom.sources.objects import list_objects, read_click_lines
from ledgerloom.sources.scores import read_scores_csv
from ledgerloom.sources.tables import declared
from ledgerloom.streaming.clicks import distinct_recent_clicks, ingest_clicks
from ledgerloom.streaming.ledger import ingest_click_days, ingest_new_objects

from .entities import BASE_TABLES, Entities

# The day the refresh windows are taken for: the events table covers January 2024.
TODAY = date(2024, 1, 20)
WEEKS_TODAY = date(2024, 1, 30)

Query = Callable[[SparkSession, str], DataFrame]


def _po_inputs(e: Entities) -> list[DataFrame]:
    return e.frames(
        "purchase_orders", "currencies", "shippings", "taxes", "providers", "action_items"
    )


def po_status(spark, folder):
    return purchase_orders.with_status(Entities(spark, folder)["purchase_orders"])


def po_left_partner_number(spark, folder):
    return purchase_orders.partner_numbers(Entities(spark, folder)["purchase_orders"])


def po_report(spark, folder):
    return purchase_orders.purchase_order_report(*_po_inputs(Entities(spark, folder)), contract="valid")


def contract_rejects(spark, folder):
    return purchase_orders.purchase_order_report(
        *_po_inputs(Entities(spark, folder)), contract="rejects"
    )


def po_retail_totals(spark, folder):
    e = Entities(spark, folder)
    totals = purchase_orders.retail_totals(
        *e.frames("purchase_orders", "milestones", "shippings", "currencies")
    )
    prices = [c for c in totals.columns if c != "id"]
    return totals.select("id", *[F.round(F.col(c).cast("double"), 8).alias(c) for c in prices])


def po_retail_exact(spark, folder):
    """The exact decimals of the totals, as text."""
    e = Entities(spark, folder)
    totals = purchase_orders.retail_totals(
        *e.frames("purchase_orders", "milestones", "shippings", "currencies")
    )
    exact = ("retail_subtotal_price", "retail_tax_amount", "retail_total_price")
    return totals.select("id", *[F.col(c).cast("string").alias(c) for c in exact])


def _without(frame: DataFrame, **columns: int) -> DataFrame:
    """A frame whose rows lack a column where their id is a multiple of the column's number."""
    lost = {c: F.when(F.col("id") % n != 0, F.col(c)) for c, n in columns.items()}
    return frame.withColumns(lost)


def _broken_currencies(e: Entities) -> DataFrame:
    return _without(e["currencies"], conversion_rate=5, currency=7)


def broken_purchase_orders(spark, folder):
    """Every rule of purchase orders broken by some rows."""
    e = Entities(spark, folder)
    po, _, *rest = _po_inputs(e)
    po = _without(po, uuid=11, rejected=13, obsoleted=17)
    return purchase_orders.purchase_order_report(po, _broken_currencies(e), *rest, contract="rejects")


def broken_proposals(spark, folder):
    e = Entities(spark, folder)
    rows, _, *rest = e.frames("proposals", "currencies", "turn_around_times", "taxes", "providers")
    rows = _without(rows, justifications=11, uuid=13)
    return proposals.proposal_report(rows, _broken_currencies(e), *rest, contract="rejects")


def broken_orders(spark, folder):
    rows, *rest = Entities(spark, folder).frames("orders", "providers", "requests", "users", "timepoints")
    return orders.order_report(_without(rows, request_id=3, booster=5), *rest, contract="rejects")


def broken_invoices(spark, folder):
    e = Entities(spark, folder)
    rows = _without(e["invoices"], uuid=11)
    currencies = e["currencies"].where(F.col("exchangable_id") % 6 != 0)
    return invoices.invoice_report(rows, currencies, e["shippings"], contract="rejects")


def proposal_report(spark, folder):
    return proposals.proposal_report(
        *Entities(spark, folder).frames(
            "proposals", "currencies", "turn_around_times", "taxes", "providers"
        )
    )


def tat_adjusted(spark, folder):
    return proposals.adjusted_turn_around(Entities(spark, folder)["turn_around_times"])


def _order_report(spark, folder, key):
    inputs = Entities(spark, folder).frames("orders", "providers", "requests", "users", "timepoints")
    return orders.order_report(*inputs, timepoint_key=key)


def order_report(spark, folder):
    return _order_report(spark, folder, "order_id")


def order_report_by_timepoint_id(spark, folder):
    return _order_report(spark, folder, "id")


def order_timepoint_pivot(spark, folder):
    return orders.step_dates(Entities(spark, folder)["timepoints"])


def invoice_report(spark, folder):
    return invoices.invoice_report(
        *Entities(spark, folder).frames("invoices", "currencies", "shippings"), contract="valid"
    )


def invoice_rejects(spark, folder):
    return invoices.invoice_report(
        *Entities(spark, folder).frames("invoices", "currencies", "shippings"), contract="rejects"
    )


def rating_report_query(spark, folder):
    return rating_report(*Entities(spark, folder).frames("ratings", "providers"))


def _snapshot_query(name: str) -> Query:
    """A snapshot; rows that break its contract are left out, as for currencies without a rate."""

    def run(spark, folder):
        return snapshot(name, Entities(spark, folder)[SNAPSHOTS[name].table], contract="valid")

    return run


def milestone_placeholders(spark, folder):
    """Milestones with their dates as text: year 1 does not fit the nanosecond dates of pandas."""
    rows = snapshot("milestones", Entities(spark, folder)["milestones"])
    dated = ("created_at", "updated_at", "cancelled_at", "shipped_at", "estimated_date")
    return rows.withColumns({c: F.col(c).cast("string") for c in dated})


def user_full_name(spark, folder):
    return snapshot("users", Entities(spark, folder)["users"]).select("id", "full_name")


def address_line(spark, folder):
    return address_lines(Entities(spark, folder)["addresses"])


def inventories_grouped(spark, folder):
    return grouped_inventories(*Entities(spark, folder).frames("inventories", "inventory_groups"))


def events_month_week(spark, folder):
    return events.events_by_module(Entities(spark, folder)["events"])


def events_month_week_windowed(spark, folder):
    spans = [span for _, span in events.refresh_spans(spark, TODAY)]
    return events.events_by_module(Entities(spark, folder)["events"], spans)


def events_session_email(spark, folder):
    spans = [span for _, span in events.week_spans(spark, WEEKS_TODAY)]
    return events.events_with_email(Entities(spark, folder)["events"], spans)


def events_email_incremental(spark, folder):
    """The same in two steps: a written state of the first days of each week, then the later days on top."""
    spans = [span for _, span in events.week_spans(spark, WEEKS_TODAY)]
    source = Entities(spark, folder)["events"]
    early = F.dayofweek("created_at").isin(2, 3, 4)
    path = f"{work_folder(spark)}/state"
    events.email_state(source.where(early)).write.partitionBy("week").parquet(path)
    state = spark.read.parquet(path)
    later = events.events_with_email(source.where(~early), spans, state=state)
    # What the early days get is only settled by the later ones.
    whole = events.merged_email_states(state, events.email_state(source.where(~early)))
    return later.unionByName(events.events_with_email(source.where(early), spans, state=whole))


def events_iso_week_counts(spark, folder):
    rows = events.events_with_email(Entities(spark, folder)["events"])
    return rows.groupBy("dt_year", "dt_month", "dt_start_week").agg(
        F.count(F.lit(1)).alias("events"), F.count("full_email").alias("with_email")
    )


def forms_windowed(spark, folder):
    spans = [span for _, span in events.refresh_spans(spark, TODAY, "contiguous")]
    return events.forms_by_module(Entities(spark, folder)["embedded_dynamic_forms"], spans)


def forms_month_week(spark, folder):
    return events.forms_by_module(Entities(spark, folder)["embedded_dynamic_forms"])


def clicks_flatten(spark, folder):
    return clicks.flat_clicks(Entities(spark, folder)["clicks"])


def clicks_dedupe(spark, folder):
    return clicks.first_clicks(Entities(spark, folder)["session_clicks"])


def clicks_new_only(spark, folder):
    """Event and session clicks whose key was not stored by the clicks of purchases."""
    e = Entities(spark, folder)
    stored = e["clicks"].where(F.col("file_name") == "purchase.gz")
    return clicks.unseen_clicks(e["clicks"].unionByName(e["session_clicks"]), stored)


def clicks_high_water_mark(spark, folder):
    return clicks.high_water_mark(Entities(spark, folder)["clicks"])


def clicks_high_water_marks(spark, folder):
    """Marks of five record kinds, one of them without rows."""
    rows = Entities(spark, folder)["clicks"]
    kinds = ("view", "signup", "purchase", "click", "impression")
    return clicks.high_water_marks({k: rows.where(F.col("file_name") == f"{k}.gz") for k in kinds})


def clicks_from_objects(spark, folder):
    """Clicks written as gzip JSON lines under a day folder and read back by key."""
    base = work_folder(spark)
    lines = Entities(spark, folder)["clicks"].select(F.col("data").alias("value"))
    lines.write.option("compression", "gzip").text(f"{base}/2024/01/18/clicks")
    lines.write.option("compression", "gzip").text(f"{base}/2024/01/18/other")
    lines.write.option("compression", "gzip").text(f"{base}/2024/01/02/clicks")
    return clicks.click_rows(read_click_lines(spark, base, TODAY)).select("id", "data")


def clicks_inserted_twice(spark, folder):
    """Insert-if-absent run twice over the same rows."""
    target = dataset_path(work_folder(spark), "clicks")
    rows = Entities(spark, folder)["session_clicks"]
    insert_new_clicks(rows, target)
    insert_new_clicks(rows, target)
    return stored_clicks(spark, target)


def clicks_inserted_bucketed(spark, folder):
    """The same into a catalog table bucketed by id."""
    rows = Entities(spark, folder)["session_clicks"]
    table = "ledgerloom_clicks"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    create_click_table(spark, table, dataset_path(work_folder(spark), "clicks"), 8)
    insert_new_clicks_into(rows, table, 8)
    insert_new_clicks_into(rows, table, 8)
    return spark.table(table)


def stream_clicks_available_now(spark, folder):
    """The events files as a stream of clicks, inserted by key."""
    base = spark.read.parquet(f"{folder}/events.parquet")
    # A glob, because a streaming path must not be a single plain file.
    stream = spark.readStream.schema(base.schema).parquet(f"{folder}/events.parque[t]")
    text = F.col("user_id").cast("string")
    rows = stream.select(
        F.concat(F.lit('"'), text, F.lit('"')).alias("id"),
        F.concat(F.lit('{"Id":"'), text, F.lit('"}')).alias("data"),
        F.concat("event_type", F.lit(".gz")).alias("file_name"),
        F.col("ts").alias("last_modified_date"),
        F.year("ts").alias("year"),
    )
    work = work_folder(spark)
    query = ingest_clicks(rows, f"{work}/clicks", f"{work}/checkpoint")
    query.awaitTermination()
    return stored_clicks(spark, f"{work}/clicks")


def stream_clicks_bucketed(spark, folder):
    """Clicks of a stream of files, inserted into a catalog table bucketed by id."""
    work = work_folder(spark)
    Entities(spark, folder)["session_clicks"].write.parquet(f"{work}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{work}/in").schema).parquet(f"{work}/in")
    table = "ledgerloom_stream_clicks"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    ingest_clicks(stream, f"{work}/clicks", f"{work}/state", table, 8).awaitTermination()
    return spark.table(table)


def booster_writeback(spark, folder):
    return boost.boosted(*Entities(spark, folder).frames("wpcs", "boost_scores"))


def page_keyset(spark, folder):
    return page_after(Entities(spark, folder)["wares"], "id", 99)


def page_offset(spark, folder):
    return page_at(Entities(spark, folder)["wares"], "id", 1)


def page_all(spark, folder):
    """Every ware with the number and the size of its page."""
    wares = Entities(spark, folder)["wares"]
    return paged(wares, "id", f"{work_folder(spark)}/keys").select("id", "name", "page", "page_rows")


def semi_reduced_children(spark, folder):
    """Currencies of proposals that exist."""
    e = Entities(spark, folder)
    owned = e["currencies"].where(F.col("exchangable_type") == "Pg::ProposalBase")
    active = e["proposals"].where("active")
    kept = keep_related(owned, active, {"exchangable_id": "id"})
    return kept.withColumn("conversion_rate", F.col("conversion_rate").cast("double"))


def _picked_shippings(spark, folder, pick: str) -> DataFrame:
    owned = F.col("shipable_type").like("Pg::PurchaseOrder%")
    rows = Entities(spark, folder)["shippings"].where(owned)
    chosen = pick_rows(rows, ["shipable_id"], "id", pick)
    return chosen.withColumn("cost", F.col("cost").cast("double"))


def last_wins(spark, folder):
    return _picked_shippings(spark, folder, "last")


def first_wins(spark, folder):
    return _picked_shippings(spark, folder, "first")


def _order_days(spark, folder) -> DataFrame:
    days = Entities(spark, folder).base("orders").select(F.to_date("o_orderdate").alias("day"))
    return days.distinct()


def month_week_calendar(spark, folder):
    """Every calendar column, for each day with an order."""
    day = F.col("day")
    year, month, week = F.year(day), F.month(day), calendar.module(day)
    return _order_days(spark, folder).select(
        "day",
        calendar.next_day(day).alias("next_day"),
        calendar.previous_day(day).alias("previous_day"),
        calendar.next_month_start(day).alias("next_month"),
        calendar.previous_month_end(day).alias("previous_month"),
        calendar.month_start(day).alias("month_start"),
        calendar.month_end(day).alias("month_end"),
        week.alias("module"),
        calendar.is_leap(year).alias("is_leap"),
        calendar.module_pair(day)[0].alias("earlier_module"),
        calendar.module_first_day(year, month, week).alias("module_first_day"),
        calendar.module_last_day(year, month, week).alias("module_last_day"),
        calendar.week_start(day).alias("week_start"),
        calendar.month_week_label(day).alias("label"),
    )


def _windows_of_days(spark, folder, windows) -> DataFrame:
    rows = _order_days(spark, folder).select("day", F.explode(windows(F.col("day"))).alias("w"))
    return rows.select("day", "w.*")


def refresh_windows(spark, folder):
    """The modules to rebuild, for each day with an order."""
    return _windows_of_days(spark, folder, calendar.month_week_windows)


def refresh_windows_contiguous(spark, folder):
    return _windows_of_days(spark, folder, calendar.contiguous_windows)


def refresh_weeks(spark, folder):
    days = _order_days(spark, folder)
    return days.select("day", F.explode(calendar.trailing_weeks(F.col("day"))).alias("monday"))


def _refreshed_events(spark, folder) -> tuple[DataFrame, str]:
    """All modules written once, then the windows of TODAY replaced from the source."""
    path = dataset_path(work_folder(spark), "events")
    source = Entities(spark, folder)["events"]
    first = events.events_by_module(source)
    first.write.partitionBy("dt").parquet(path)
    spans = events.refresh_spans(spark, TODAY)
    fresh = events.events_by_module(source, [span for _, span in spans])
    return refresh_partitions(fresh, path, ["dt"], [{"dt": label} for label, _ in spans]), path


def run_manifest(spark, folder):
    manifest, _ = _refreshed_events(spark, folder)
    return manifest.select("window_start", "rows")


def partition_refresh(spark, folder):
    _, path = _refreshed_events(spark, folder)
    return spark.read.option("recursiveFileLookup", "false").parquet(path).select(
        "id", F.col("dt").cast("string").alias("dt")
    )


def week_partition_refresh(spark, folder):
    """Session e-mails written by ISO week, with the manifest of the run."""
    path = dataset_path(work_folder(spark), "emails")
    weeks = events.week_spans(spark, WEEKS_TODAY)
    rows = events.events_with_email(Entities(spark, folder)["events"], [s for _, s in weeks])
    windows = [
        {"dt_year": m.year, "dt_month": m.month, "dt_start_week": m.day} for m, _ in weeks
    ]
    manifest = refresh_partitions(rows, path, ["dt_year", "dt_month", "dt_start_week"], windows)
    return manifest.select("window_start", "rows")


def snapshot_registered(spark, folder):
    """A snapshot written, registered in the catalog and read by name."""
    path = dataset_path(work_folder(spark), "wares")
    rows = snapshot("wares", Entities(spark, folder)["wares"])
    write_snapshot(rows, path)
    spark.sql("DROP TABLE IF EXISTS ledgerloom_wares")
    register(spark, "ledgerloom_wares", path, rows.schema)
    return spark.table("ledgerloom_wares")


def booster_published(spark, folder):
    """Scores exported to CSV and read back, written to a new version, registered and read by name."""
    work = work_folder(spark)
    wpcs, scores = Entities(spark, folder).frames("wpcs", "boost_scores")
    columns = StructType.fromDDL(BOOST_SCORES).names
    scores.select(columns).write.option("header", "true").csv(f"{work}/scores")
    write_snapshot(wpcs, f"{work}/wpcs/version=v1")
    spark.sql("DROP TABLE IF EXISTS ledgerloom_wpcs")
    register(spark, "ledgerloom_wpcs", f"{work}/wpcs/version=v1", wpcs.schema)
    read = read_scores_csv(spark, f"{work}/scores")
    write_boosted(spark.table("ledgerloom_wpcs"), read, f"{work}/wpcs", "v2", table="ledgerloom_wpcs")
    return spark.table("ledgerloom_wpcs")


def footer_row_counts(spark, folder):
    """Rows of every table, from the footers."""
    rows = [(t, row_count(spark, f"{folder}/{t}.parquet")) for t in BASE_TABLES]
    return spark.createDataFrame(rows, "table_name string, rows long")


def stream_distinct_keys(spark, folder):
    """Clicks of a stream of files, de-duplicated with bounded state."""
    work = work_folder(spark)
    Entities(spark, folder)["session_clicks"].write.parquet(f"{work}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{work}/in").schema).parquet(f"{work}/in")
    kept = distinct_recent_clicks(stream, "3650 days").select("id", "year")
    _run_to_end(kept, work)
    return spark.read.schema("id string, year int").parquet(f"{work}/out")


def stream_clicks_flatten(spark, folder):
    """Clicks of a stream of files, flattened."""
    work = work_folder(spark)
    Entities(spark, folder)["clicks"].write.parquet(f"{work}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{work}/in").schema).parquet(f"{work}/in")
    flat = clicks.flat_clicks(stream)
    _run_to_end(flat, work)
    return spark.read.schema(flat.schema).parquet(f"{work}/out")


def _run_to_end(stream: DataFrame, work: str) -> None:
    """Write what is available of a stream to the work folder's `out`."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{work}/state")
    writer.trigger(availableNow=True).start(f"{work}/out").awaitTermination()


def _day_objects(spark, folder, base: str, late: bool) -> None:
    """Click objects of two days; with `late` also one more in the older folder, with clicks of its own."""
    rows = Entities(spark, folder)["session_clicks"]
    days = {"2024/01/17": ("view", "signup"), "2024/01/18": ("purchase", "signup")}
    if late:
        days = {"2024/01/17/late": ("click", "impression")}
    for day, kinds in days.items():
        lines = rows.where(F.col("file_name").isin(*[f"{k}.gz" for k in kinds])).select(F.col("data").alias("value"))
        lines.write.option("compression", "gzip").text(f"{base}/{day}/clicks")


def clicks_from_ledger(spark, folder):
    """Objects of day folders ingested on two days by the ledger, one of them late, and once more."""
    work = work_folder(spark)
    args = (f"{work}/clicks", f"{work}/ledger")
    _day_objects(spark, folder, f"{work}/in", late=False)
    ingest_new_objects(spark, f"{work}/in", date(2024, 1, 17), *args)
    _day_objects(spark, folder, f"{work}/in", late=True)
    for _ in range(2):
        ingest_new_objects(spark, f"{work}/in", date(2024, 1, 18), *args)
    this_year = F.col("year") == F.year(F.current_timestamp())
    return stored_clicks(spark, f"{work}/clicks").select("id", this_year.alias("this_year"))


def stream_click_objects(spark, folder):
    """The same objects as streams of gzip text, a checkpoint for every day folder."""
    work = work_folder(spark)
    _day_objects(spark, folder, f"{work}/in", late=False)
    ingest_click_days(spark, f"{work}/in", f"{work}/clicks", f"{work}/state", date(2024, 1, 17), 2)
    _day_objects(spark, folder, f"{work}/in", late=True)
    ingest_click_days(spark, f"{work}/in", f"{work}/clicks", f"{work}/state", date(2024, 1, 18), 2)
    this_year = F.col("year") == F.year(F.current_timestamp())
    return stored_clicks(spark, f"{work}/clicks").select("id", this_year.alias("this_year"))


def booster_files(spark, folder):
    """Scores written into a versioned table by file, and a second time without effect."""
    work = work_folder(spark)
    wpcs, scores = Entities(spark, folder).frames("wpcs", "boost_scores")
    rows = declared(wpcs, "wpcs")
    write_full(rows.repartitionByRange(16, "ware_id"), f"{work}/wpcs")
    for _ in range(2):
        boost_files(spark, scores, f"{work}/wpcs")
    return read_version(spark, f"{work}/wpcs", rows.schema)


def declared_names(spark, folder):
    """Purchase orders with the database's own column names, read under the declared ones."""
    rows = Entities(spark, folder)["purchase_orders"].withColumnRenamed("type_", "type")
    return declared(rows, "purchase_orders").select("id", "type_", "po_number", "provider_id")


def listing_by_prefix(spark, folder):
    """Tables found by listing the folder, with the rows of their files."""
    name = lambda path: F.regexp_extract(path, r"([a-z_]+)\.parquet", 1)
    found = list_objects(spark, folder, "*.parquet").select(name(F.url_decode("path")).alias("table_name")).distinct()
    counts = None
    for t in BASE_TABLES:
        one = spark.read.parquet(f"{folder}/{t}.parquet").select(F.lit(t).alias("table_name"))
        counts = one if counts is None else counts.unionByName(one)
    rows = counts.groupBy("table_name").agg(F.count("*").alias("rows"))
    return found.join(rows, "table_name")


QUERIES: dict[str, Query] = {
    "po_status": po_status,
    "po_left_partner_number": po_left_partner_number,
    "po_report": po_report,
    "po_retail_totals": po_retail_totals,
    "contract_rejects": contract_rejects,
    "po_retail_exact": po_retail_exact,
    "broken_purchase_orders": broken_purchase_orders,
    "broken_proposals": broken_proposals,
    "broken_orders": broken_orders,
    "broken_invoices": broken_invoices,
    "proposal_report": proposal_report,
    "tat_adjusted": tat_adjusted,
    "order_report": order_report,
    "order_report_by_timepoint_id": order_report_by_timepoint_id,
    "order_timepoint_pivot": order_timepoint_pivot,
    "invoice_report": invoice_report,
    "invoice_rejects": invoice_rejects,
    "rating_report": rating_report_query,
    "provider_completeness": _snapshot_query("providers"),
    "request_filters": _snapshot_query("requests"),
    "user_full_name": user_full_name,
    "address_line": address_line,
    "refs_json_fields": _snapshot_query("refs_users"),
    "refs_provider_score": _snapshot_query("refs_providers"),
    "milestone_placeholders": milestone_placeholders,
    "snapshot_pruned": _snapshot_query("addresses"),
    **{
        f"snapshot_{name}": _snapshot_query(name)
        for name in (
            "currencies", "inventories", "inventory_groups", "notes", "organizations",
            "shippings", "taxes", "users", "wares", "wpcs",
        )
    },
    "inventories_grouped": inventories_grouped,
    "events_month_week": events_month_week,
    "events_month_week_windowed": events_month_week_windowed,
    "events_session_email": events_session_email,
    "events_email_incremental": events_email_incremental,
    "events_iso_week_counts": events_iso_week_counts,
    "forms_windowed": forms_windowed,
    "forms_month_week": forms_month_week,
    "clicks_flatten": clicks_flatten,
    "clicks_dedupe": clicks_dedupe,
    "clicks_new_only": clicks_new_only,
    "clicks_high_water_mark": clicks_high_water_mark,
    "clicks_high_water_marks": clicks_high_water_marks,
    "clicks_from_objects": clicks_from_objects,
    "clicks_inserted_twice": clicks_inserted_twice,
    "clicks_inserted_bucketed": clicks_inserted_bucketed,
    "stream_clicks_available_now": stream_clicks_available_now,
    "booster_writeback": booster_writeback,
    "page_keyset": page_keyset,
    "page_offset": page_offset,
    "page_all": page_all,
    "semi_reduced_children": semi_reduced_children,
    "last_wins": last_wins,
    "first_wins": first_wins,
    "month_week_calendar": month_week_calendar,
    "refresh_windows": refresh_windows,
    "refresh_windows_contiguous": refresh_windows_contiguous,
    "refresh_weeks": refresh_weeks,
    "run_manifest": run_manifest,
    "partition_refresh": partition_refresh,
    "week_partition_refresh": week_partition_refresh,
    "snapshot_registered": snapshot_registered,
    "listing_by_prefix": listing_by_prefix,
    "booster_published": booster_published,
    "booster_files": booster_files,
    "clicks_from_ledger": clicks_from_ledger,
    "stream_click_objects": stream_click_objects,
    "declared_names": declared_names,
    "footer_row_counts": footer_row_counts,
    "stream_clicks_bucketed": stream_clicks_bucketed,
    "stream_distinct_keys": stream_distinct_keys,
    "stream_clicks_flatten": stream_clicks_flatten,
}
