"""One day from landing files to reports."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestay import fixed_values as fv
from lakestay.operators.quality import check_report
from lakestay.plans import checks, dimensions, facts, inventory, reports, staging
from lakestay.plans.bronze import bronze_ingest
from lakestay.plans.silver import cleanse
from lakestay.session import configure, delete_folder, work_folders
from lakestay.sinks.audit import append_audit
from lakestay.sinks.batches import refresh
from lakestay.sinks.staging import publish_staging
from lakestay.sinks.versioned import VersionedTable, change, is_versioned
from lakestay.sources import seeds
from lakestay.sources.readers import SOURCES, read_layer, read_table

log = logging.getLogger(__name__)


class StepFailed(RuntimeError):
    """Some sources, entities or checks of a step failed."""


def run_all(names: Iterable[str], job: Callable[[str], object]) -> tuple[dict, list[str]]:
    """Run a job for every name even when some fail: (results, failed names)."""
    results, failed = {}, []
    for name in names:
        try:
            results[name] = job(name)
        except Exception as error:  # noqa: BLE001
            log.error("%s failed: %s", name, error)
            results[name] = {"error": str(error)}
            failed.append(name)
    return results, failed


def staging_table(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/staging/{name}"


def analytics_table(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/analytics/{name}"


def load_staging(spark: SparkSession, root: str, name: str, date: str) -> int:
    contract = (*fv.STAGING_COLUMNS[name], *fv.STAGING_META)
    silver = read_layer(spark, root, "silver", name, date)
    return publish_staging(
        silver, contract, fv.STAGING_DEFAULTS[name], staging_table(root, name), date,
        sort_by=fv.STAGING_VERSIONS[name][0][:1],
    )


def batches_of(spark: SparkSession, table: str) -> list[str]:
    """The days a table has a folder for."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{fv.BATCH_DATE}=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted(str(s.getPath()).rsplit("=", 1)[1] for s in found)


def days_to_apply(target: VersionedTable, staged: list[str], date: str) -> list[str]:
    """The day itself and staged days an earlier run did not get to."""
    return sorted({*staged, date} - target.applied() | {date})


def build_dimension(spark: SparkSession, root: str, history: dimensions.History, date: str) -> None:
    """Merge one day's snapshot into a dimension; all snapshots while there is no table of it.

    Ids of changed hotels are written down before the dimension changes, for the room nights.
    """
    path, source = analytics_table(root, history.name), staging_table(root, history.source)
    staged = batches_of(spark, source)
    raw = read_table(spark, source)
    if not is_versioned(spark, path):
        whole = history.build(staging.staging_view(history.source, raw))
        target = VersionedTable.create(whole, path, [history.key], [history.key], "valid_from")
        target.note_applied(staged)
        return
    target = VersionedTable.open(spark, path)
    for day in days_to_apply(target, staged, date):
        own = F.col(fv.BATCH_DATE) == F.lit(day).cast("date")
        after = [d for d in target.applied() if d > day]
        later = staging.staging_keys(history.source, raw.filter(F.col(fv.BATCH_DATE).isin(
            [F.lit(d).cast("date") for d in after]
        ))) if after else None
        with work_folders(spark, "touched-keys") as (folder,):
            touched, rows = dimensions.merge_snapshot(
                history, target.read(), staging.staging_view(history.source, raw.filter(own)), later, day, folder
            )
            if touched.limit(1).count():
                if history.name == "dim_hotels":
                    touched.write.parquet(f"{root.rstrip('/')}/analytics/_changed_hotels/{day}-{uuid.uuid4().hex}")
                # A key whose only snapshot is gone has no rows left.
                gone = touched.join(rows.select(history.key), history.key, "left_anti")
                target.upsert(rows, sort_by=[history.key])
                if gone.limit(1).count():
                    target.delete(gone, sort_by=[history.key])
        target.note_applied([day])


def build_dimensions(spark: SparkSession, root: str, date: str) -> None:
    for history in dimensions.HISTORIES:
        build_dimension(spark, root, history, date)
    refresh(seeds.dim_channels(spark), analytics_table(root, "dim_channels"))
    refresh(seeds.dim_geography(spark), analytics_table(root, "dim_geography"))
    refresh(seeds.dim_dates(spark), analytics_table(root, "dim_dates"))


def build_inventory(spark: SparkSession, root: str, date: str, hotels: DataFrame, fx: DataFrame) -> None:
    """Bring the room nights up to date with the day; all bookings while there is no table of them."""
    fact, kept = analytics_table(root, "fact_hotel_inventory"), analytics_table(root, "booked_stays")
    pending = analytics_table(root, "_inventory_change")
    source = staging_table(root, "bookings")
    staged, raw = batches_of(spark, source), read_table(spark, source)
    journal = analytics_table(root, "_changed_hotels")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{journal}/*")
    noted = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    names = [str(s.getPath()) for s in noted]
    if is_versioned(spark, fact):
        target = VersionedTable.open(spark, fact)
        changed = [(spark.read.parquet(n), n.rsplit("/", 1)[1][:10]) for n in names]
        for day in days_to_apply(target, staged, date):
            inventory.update(raw, hotels, fx, fact, kept, pending, day, changed)
            target.note_applied([day])
            changed = []
    else:
        delete_folder(spark, pending)
        inventory.build(staging.stg_bookings(raw), hotels, fx, fact, kept)
        VersionedTable.open(spark, fact).note_applied(staged)
    for name in names:
        delete_folder(spark, name)


def build_sessions(spark: SparkSession, root: str, date: str, customers: DataFrame) -> list[str]:
    """Upsert the sessions a batch touches; all sessions while there is no table of them.

    The events are stored, as they are used twice and tell which batches of
    bookings can hold what a session led to.
    """
    target = analytics_table(root, "fact_web_sessions")
    clicks, booked = (read_table(spark, staging_table(root, n)) for n in ("clickstream", "bookings"))
    if is_versioned(spark, target):
        events = facts.touched_sessions(staging.staging_sessions(clicks, date), date)
    else:
        events = staging.stg_clickstream(clicks)
    with work_folders(spark, "session-events") as (folder,):
        events.write.parquet(folder)
        events = spark.read.parquet(folder)
        completed = events.filter(F.col("event_type") == "booking_complete")
        days = [r[0] for r in completed.select(fv.BATCH_DATE).distinct().collect()]
        # A batch is as good as any other where no session led to a booking.
        since = min(days, default=dt.date.fromisoformat(date))
        bookings = staging.stg_bookings(booked.filter(F.col(fv.BATCH_DATE) >= F.lit(since)))
        bookings = bookings.filter(F.col(fv.BATCH_DATE).isin(days or [since]))
        sessions = facts.fact_web_sessions(events, bookings, customers)
        return change(sessions, target, ["session_id"], ["session_date_id", "session_id"])


def build_facts(spark: SparkSession, root: str, date: str) -> dict[str, list[str]]:
    """Upsert the day's bookings, payments and sessions; count its bookings into and out of
    the room nights. A fact that has no table yet gets all batches."""
    table = lambda name: read_table(spark, analytics_table(root, name))
    fx = seeds.fx_rates(spark)
    hotels, customers, channels = table("dim_hotels"), table("dim_customers"), table("dim_channels")

    def batch(name):
        exists = is_versioned(spark, analytics_table(root, f"fact_{name}"))
        return staging.staging_batch(name, read_table(spark, staging_table(root, name)), date, exists)

    days = {}
    bookings = facts.fact_bookings(batch("bookings"), hotels, customers, channels, fx)
    days["fact_bookings"] = change(
        bookings, analytics_table(root, "fact_bookings"), ["booking_id"],
        ["hotel_sk", "checkin_date_id", "booking_id"],
    )
    payments = facts.fact_payments(batch("payments"), table("fact_bookings"), fx)
    days["fact_payments"] = change(
        payments, analytics_table(root, "fact_payments"), ["payment_id"],
        ["customer_sk", "payment_date_id", "payment_id"],
    )
    days["fact_web_sessions"] = build_sessions(spark, root, date, customers)
    build_inventory(spark, root, date, hotels, fx)
    return days


def build_reports(spark: SparkSession, root: str, date: str) -> None:
    table = lambda name: read_table(spark, analytics_table(root, name))
    hotels, bookings = table("dim_hotels"), table("fact_bookings")
    refresh(
        reports.rpt_daily_revenue(bookings, hotels, table("dim_channels")),
        analytics_table(root, "rpt_daily_revenue"), ["report_date", "country", "channel_name"],
    )
    refresh(
        reports.rpt_hotel_performance(hotels, bookings, table("fact_payments"), date),
        analytics_table(root, "rpt_hotel_performance"),
    )
    refresh(
        reports.rpt_conversion_funnel(table("fact_web_sessions")),
        analytics_table(root, "rpt_conversion_funnel"),
    )


def verify_tables(spark: SparkSession, root: str) -> dict[str, int]:
    """Run all checks; the violations per check, warnings only, if none is an error."""
    tables = {f"staging_{n}": read_table(spark, staging_table(root, n)) for n in fv.STAGING_COLUMNS}
    names = {t for t in (*checks.NOT_NULL, *checks.UNIQUE) if not t.startswith("staging_")}
    tables |= {n: read_table(spark, analytics_table(root, n)) for n in sorted(names)}
    report = check_report(checks.warehouse_checks(tables)).filter("status <> 'pass'").collect()
    errors = [f"{r['check_name']}: {r['violations']}" for r in report if r["severity"] == "error"]
    if errors:
        raise StepFailed("; ".join(errors))
    return {r["check_name"]: r["violations"] for r in report}


def run_day(
    spark: SparkSession,
    root: str,
    date: str,
    run_id: str | None = None,
    max_ratio: float = fv.MAX_REJECT_RATIO,
) -> dict[str, object]:
    """Bronze, silver, staging, dimensions, facts, reports and checks of one day.

    Each step leaves an audit row. Within a step one failing source does not
    stop the others; the day stops after the step. Any day can be run again.
    """
    configure(spark)
    run_id = run_id or uuid.uuid4().hex[:8]
    audit = analytics_table(root, "run_audit")

    def for_all(names, job):
        def step():
            results, failed = run_all(names, job)
            if failed:
                errors = {n: results[n]["error"] for n in failed}
                raise StepFailed(f"{errors}")
            return results
        return step

    steps = {
        "bronze": for_all(SOURCES, lambda n: bronze_ingest(spark, SOURCES[n], root, date, run_id)),
        "silver": for_all(SOURCES, lambda n: cleanse(spark, root, n, date, max_ratio)),
        "staging": for_all(SOURCES, lambda n: {"rows": load_staging(spark, root, n, date)}),
        "dimensions": lambda: build_dimensions(spark, root, date),
        "facts": lambda: build_facts(spark, root, date),
        "reports": lambda: build_reports(spark, root, date),
        "checks": lambda: verify_tables(spark, root),
    }
    row_metric = {"bronze": "bronze_rows", "silver": "silver_rows", "staging": "rows"}
    done = {}
    for name, step in steps.items():
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        try:
            done[name] = step()
        except Exception as error:
            try:
                append_audit(spark, audit, run_id, date, name, started, error=str(error))
            except Exception:  # noqa: BLE001
                # The step's own error is the one to raise.
                log.exception("no audit row for %s", name)
            raise
        metric = row_metric.get(name)
        rows = sum(r[metric] for r in done[name].values()) if metric else 0
        append_audit(spark, audit, run_id, date, name, started, rows, details=done[name])
    return done
