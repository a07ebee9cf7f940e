"""Public projections, and pages of them in their fixed orders.

Bulk pages (one page for each of many shipments or retailers) filter on a row number. Catalyst
pushes that limit below the shuffle (WindowGroupLimit), so each task ships at most one page per
group and a heavy group stays cheap. Totals come from an aggregate combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import model as M

_LIMITS = dict(M.PAGE_LIMITS)


def shipment_view(shipments: DataFrame) -> DataFrame:
    return shipments.select(
        "shipment_id", "retailer_id", "tracking_number", "carrier_code", "current_status",
        "estimated_delivery_date", "last_event_time", "version", "created_at", "updated_at")


def history_view(history: DataFrame) -> DataFrame:
    return history.select(
        "event_id", "normalized_event_type", "carrier_event_type", "carrier_code", "event_time",
        "received_at", "sequence_number", "location", "description", "processing_status", "correlation_id")


def notification_view(notifications: DataFrame) -> DataFrame:
    return notifications.select(
        "notification_id", "source_event_id", "notification_type", "channel", "status", "created_at")


def failed_event_view(failed: DataFrame, categories: DataFrame, *more: str) -> DataFrame:
    """Without the payload; the category's retry flags come from the category table. ``more`` columns stay."""
    return failed.join(categories, "error_category").select(
        "failed_event_id", "event_id", "shipment_id", "error_category", "retryable_automatically",
        "retryable_manually", "error_type", "error_message", "retry_count", "status", "original_topic",
        "original_partition", "original_offset", "first_failed_at", "last_failed_at", *more)


def history_page(history: DataFrame, ids: DataFrame | None = None, page: int = 0, size: int = 20) -> DataFrame:
    """A page of history per shipment, in the order things happened (not arrived)."""
    return _group_page(_for(history, ids), ["shipment_id"], history_view,
                       ["event_time", "sequence_number", "event_id"], page, size, "history")


def notifications_page(notifications: DataFrame, ids: DataFrame | None = None, page: int = 0,
                       size: int = 20) -> DataFrame:
    """A page of notifications per shipment, oldest first."""
    return _group_page(_for(notifications, ids), ["shipment_id"], notification_view,
                       ["created_at", "notification_id"], page, size, "notifications")


def retailer_page(shipments: DataFrame, retailer: str | None = None, status: str | None = None,
                  page: int = 0, size: int = 20) -> DataFrame:
    """A page of shipments, newest first, of one retailer or of each."""
    chosen = shipments
    if retailer is not None:
        chosen = chosen.where(F.col("retailer_id") == retailer)
    if status is not None:
        chosen = chosen.where(F.col("current_status") == status)
    return _group_page(chosen, ["retailer_id"], lambda df: shipment_view(df).drop("retailer_id"),
                       [F.col("created_at").desc(), "shipment_id"], page, size, "retailer")


def failed_events_page(failed: DataFrame, categories: DataFrame, status: str | None = None,
                       page: int = 0, size: int = 20) -> DataFrame:
    """A page of the failed events, latest failure first."""
    size = _checked(page, size, "failed")
    chosen = failed if status is None else failed.where(F.col("status") == status)
    # cut the page first (each task sends one page), then join the tiny category table
    cut = (chosen.orderBy(F.col("last_failed_at").desc(), "failed_event_id")
           .offset(page * size).limit(size))
    total = chosen.agg(F.count("*")).scalar()
    return _with_totals(failed_event_view(cut, categories).withColumn("total_elements", total), page, size)


# --- pages after a row -------------------------------------------------------------------------
# A page that continues after the last row of the one before is as cheap at any depth: rows up to there
# are filtered out, and the rest needs no more than ``size`` rows of each group from each task.

def history_after(history: DataFrame, cursors: DataFrame, size: int = 20) -> DataFrame:
    """The page of history after a row, per shipment. ``cursors`` has that row of each shipment asked for:
    ``shipment_id``, its order columns and its ``position``. It is what a client holds, so a table; it is counted."""
    return _group_after(history, ["shipment_id"], history_view, HISTORY_ORDER, cursors, size, "history")


def notifications_after(notifications: DataFrame, cursors: DataFrame, size: int = 20) -> DataFrame:
    """The page of notifications after a row, per shipment."""
    return _group_after(notifications, ["shipment_id"], notification_view, NOTIFICATION_ORDER, cursors, size, "notifications")


def retailer_after(shipments: DataFrame, cursors: DataFrame, status: str | None = None, size: int = 20) -> DataFrame:
    """The page of shipments after a row, per retailer."""
    chosen = shipments if status is None else shipments.where(F.col("current_status") == status)
    return _group_after(chosen, ["retailer_id"], lambda df: shipment_view(df).drop("retailer_id"), RETAILER_ORDER,
                        cursors, size, "retailer")


def failed_events_after(failed: DataFrame, categories: DataFrame, last: dict | None = None, status: str | None = None,
                        size: int = 20) -> DataFrame:
    """The page of failed events after ``last`` (``last_failed_at``, ``failed_event_id`` and ``position`` of a row;
    None: the first page), in order, with positions."""
    size = _checked(0, size, "failed")
    chosen = failed if status is None else failed.where(F.col("status") == status)
    rest, base = chosen, 0
    if last is not None:
        rest, base = rest.where(_comes_after(FAILED_ORDER, lambda c: F.lit(last[c]))), last["position"]
    cut = rest.orderBy(*_sorted(FAILED_ORDER)).limit(size)          # each task sends one page
    place = F.row_number().over(Window.orderBy(*_sorted(FAILED_ORDER))) + base      # over that page alone
    total = chosen.agg(F.count("*")).scalar()
    paged = failed_event_view(cut.withColumn("position", place), categories, "position").withColumn("total_elements", total)
    return (paged.withColumn("size", F.lit(size))
            .withColumn("has_next", F.lit(base + size) < F.col("total_elements")).orderBy("position"))


_BROADCAST_ROWS = 1_000_000
HISTORY_ORDER = (("event_time", True), ("sequence_number", True), ("event_id", True))
NOTIFICATION_ORDER = (("created_at", True), ("notification_id", True))
RETAILER_ORDER = (("created_at", False), ("shipment_id", True))
FAILED_ORDER = (("last_failed_at", False), ("failed_event_id", True))


def _sorted(order) -> list[Column]:
    return [F.col(c).asc_nulls_first() if ascending else F.col(c).desc_nulls_last() for c, ascending in order]


def _comes_after(order, cursor) -> Column:
    """Rows behind the cursor's in the order; NULL is the least value, as in the sort."""
    behind, equal = F.lit(False), F.lit(True)
    for name, ascending in order:
        mine, theirs = F.col(name), cursor(name)
        more, less = (mine, theirs) if ascending else (theirs, mine)
        further = F.coalesce(more > less, F.lit(False)) | (more.isNotNull() & less.isNull())
        behind, equal = behind | (equal & further), equal & mine.eqNullSafe(theirs)
    return behind


def _group_after(df: DataFrame, by: list[str], view, order, cursors: DataFrame, size: int, kind: str) -> DataFrame:
    size = _checked(0, size, kind)
    held = cursors.select(*by, *[F.col(c).alias(f"_after_{c}") for c, _ in order], F.col("position").alias("_base"))
    if cursors.count() <= _BROADCAST_ROWS:       # then rows are filtered, and limited, where they are read
        held = F.broadcast(held)
    rest = df.join(held, by).where(_comes_after(order, lambda c: F.col(f"_after_{c}")))
    ranked = rest.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*_sorted(order))))
    rows = ranked.where(F.col("_rn") <= size)
    columns = view(df).columns
    totals = df.join(cursors.select(*by), by, "left_semi").groupBy(*by).agg(F.count("*").alias("total_elements"))
    return (rows.select(*by, *[c for c in columns if c not in by], (F.col("_base") + F.col("_rn")).cast("int").alias("position"),
                        (F.col("_base") + size).alias("_end"))
            .join(totals, by).withColumn("size", F.lit(size))
            .withColumn("has_next", F.col("_end") < F.col("total_elements")).drop("_end"))


def last_rows(page: DataFrame, by: str, order=HISTORY_ORDER) -> DataFrame:
    """The last row of each group of a page, as the cursor of the next."""
    names = ["position", *[c for c, _ in order]]
    return page.groupBy(by).agg(F.max_by(F.struct(*names), "position").alias("_c")).select(by, *[f"_c.{n}" for n in names])


# --- look-ups ----------------------------------------------------------------------------------

def look_up(ids: DataFrame, table: DataFrame, key: str, view) -> DataFrame:
    """Rows of ``table`` by id, with ``found``: an id that is not there is answered too, by a row of NULLs."""
    rows = view(table).withColumn("found", F.lit(True))
    asked = ids.select(key).distinct()
    return asked.join(rows, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def history_existence(ids: DataFrame, shipments: DataFrame, history: DataFrame) -> DataFrame:
    """Per requested shipment: is it known, and how long is its history. Known without rows is an
    empty page, unknown is not found."""
    known = shipments.select("shipment_id", F.lit(True).alias("_known"))
    rows = history.groupBy("shipment_id").agg(F.count("*").alias("_rows"))
    return (ids.select("shipment_id").distinct().join(known, "shipment_id", "left")
            .join(rows, "shipment_id", "left")
            .select("shipment_id", F.coalesce("_known", F.lit(False)).alias("found"),
                    F.when(F.col("_known"), F.coalesce("_rows", F.lit(0))).alias("total_elements")))


def history_by_tracking_number(history: DataFrame, numbers: DataFrame) -> DataFrame:
    """The history behind tracking numbers, in event-time order within each."""
    return (history.join(numbers.select("tracking_number").distinct(), "tracking_number", "left_semi")
            .select("tracking_number", *[c for c in history_view(history).columns])
            .orderBy("tracking_number", "event_time", "event_id"))


def recent_ingest(history: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` latest received rows."""
    return (history.orderBy(F.col("received_at").desc(), "event_id").limit(n)
            .select("received_at", "event_id", "shipment_id", "carrier_event_type", "processing_status"))


def _for(df: DataFrame, ids: DataFrame | None) -> DataFrame:
    return df if ids is None else df.join(ids.select("shipment_id"), "shipment_id", "left_semi")


def _checked(page: int, size: int, kind: str) -> int:
    if page < 0 or not 1 <= size <= _LIMITS[kind]:
        raise ValueError(f"page must be >= 0 and size within 1..{_LIMITS[kind]}")
    return size


def _group_page(df: DataFrame, by: list[str], view, order: list[str | Column], page: int, size: int,
                kind: str) -> DataFrame:
    size = _checked(page, size, kind)
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    rows = ranked.where((F.col("_rn") <= (page + 1) * size) & (F.col("_rn") > page * size))
    columns = view(df).columns
    totals = df.groupBy(*by).agg(F.count("*").alias("total_elements"))
    return _with_totals(rows.select(*by, *[c for c in columns if c not in by], F.col("_rn").alias("position"))
                        .join(totals, by), page, size)


def _with_totals(df: DataFrame, page: int, size: int) -> DataFrame:
    pages = F.ceil(F.col("total_elements") / size).cast("long")
    return (df.withColumn("page", F.lit(page)).withColumn("size", F.lit(size))
            .withColumn("total_pages", pages)
            .withColumn("has_next", F.lit(page + 1) < pages))
