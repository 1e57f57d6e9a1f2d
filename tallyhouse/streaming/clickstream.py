"""Clickstream tables. Every function takes a batch or a streaming frame of clickstream rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.columns import percent
from tallyhouse.operators.skew import spread_join

TIME = "event_timestamp"
#: A sketch of 2**12 slots is off by 1.6 % (one standard deviation).
SKETCH_BITS = 12
VIEW, CART, CHECKOUT = "product_view", "add_to_cart", "checkout_complete"


def _hits(kind: str):
    return F.count_if(F.col("event_type") == kind)


def bronze(events: DataFrame) -> DataFrame:
    """Typed events with the columns they are partitioned by."""
    return events.withColumns({"event_date": F.to_date(TIME), "event_hour": F.hour(TIME)})


def session_metrics(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Activity per device and referrer in 5-minute windows that start every minute."""
    grouped = events.withWatermark(TIME, delay).groupBy(F.window(TIME, "5 minutes", "1 minute"), "device_type", "referrer")
    return grouped.agg(
        F.count(F.lit(1)).alias("event_count"),
        F.approx_count_distinct("session_id").alias("unique_sessions"),
        F.approx_count_distinct("customer_id").alias("unique_customers"),
        _hits(VIEW).alias("product_views"),
        _hits(CART).alias("add_to_carts"),
        _hits(CHECKOUT).alias("checkouts"),
    ).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "device_type", "referrer", "event_count", "unique_sessions", "unique_customers",
        "product_views", "add_to_carts", "checkouts",
        percent(F.col("checkouts"), F.col("unique_sessions")).alias("conversion_rate"),
    )


def product_trending(events: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """Activity and weighted engagement per product in 15-minute windows that start every 5 minutes."""
    grouped = events.where("product_id IS NOT NULL").withWatermark(TIME, delay).groupBy(
        F.window(TIME, "15 minutes", "5 minutes"), "product_id"
    )
    weight = F.col("views") + 3 * F.col("cart_adds") + 10 * F.col("purchases")
    return grouped.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.approx_count_distinct("session_id").alias("unique_viewers"),
        _hits(VIEW).alias("views"),
        _hits(CART).alias("cart_adds"),
        _hits(CHECKOUT).alias("purchases"),
    ).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "product_id",
        "total_events", "unique_viewers", "views", "cart_adds", "purchases", weight.cast("int").alias("engagement_score"),
    )


def realtime_dashboard(events: DataFrame, delay: str = "5 minutes") -> DataFrame:
    """Events, sessions, customers and conversions per minute."""
    return events.withWatermark(TIME, delay).groupBy(F.window(TIME, "1 minute")).agg(
        F.count(F.lit(1)).alias("events_per_minute"),
        F.approx_count_distinct("session_id").alias("active_sessions"),
        F.approx_count_distinct("customer_id").alias("active_customers"),
        _hits(CHECKOUT).alias("conversions"),
    ).select(
        F.col("window.end").alias("timestamp"), "events_per_minute", "active_sessions", "active_customers", "conversions"
    )


def panes(events: DataFrame, keys: Sequence[str], pane: str, delay: str, sketches: Mapping[str, str]) -> DataFrame:
    """Tumbling panes of activity, the parts that sliding windows are made of.

    Every event is counted once, in one pane, however many windows overlap there. ``sketches`` maps a name to the column whose
    distinct values a HyperLogLog sketch of that name counts: sketches of several panes unite, counts do not. In append mode a pane
    is written once, when the watermark has passed it, and its state is released.
    """
    grouped = events.withWatermark(TIME, delay).groupBy(F.window(TIME, pane), *keys)
    return grouped.agg(
        F.count(F.lit(1)).alias("event_count"), _hits(VIEW).alias("product_views"), _hits(CART).alias("add_to_carts"), _hits(CHECKOUT).alias("checkouts"),
        *[F.hll_sketch_agg(column, SKETCH_BITS).alias(name) for name, column in sketches.items()],
    ).select(F.col("window.start").alias("pane_start"), *keys, "event_count", "product_views", "add_to_carts", "checkouts", *sketches)


def slide(parts: DataFrame, keys: Sequence[str], size: int, step: int, counts: Mapping[str, str]) -> DataFrame:
    """Windows of ``size`` minutes that start every ``step`` minutes, from panes of ``step`` minutes.

    Each pane goes to the ``size / step`` windows that hold it; their counts are sums, and their distinct counts (``counts``: name to
    sketch column) are estimates from united sketches. Batch, over the table of panes.
    """
    if size % step:
        raise ValueError("a window must be a whole number of panes")
    first = F.col("pane_start") - F.make_dt_interval(mins=F.lit(size - step))
    spread = parts.withColumn("window_start", F.explode(F.sequence(first, F.col("pane_start"), F.make_dt_interval(mins=F.lit(step)))))
    united = spread.groupBy("window_start", *keys).agg(
        *[F.sum(c).alias(c) for c in ("event_count", "product_views", "add_to_carts", "checkouts")],
        *[F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(name) for name, sketch in counts.items()],
    )
    return united.withColumn("window_end", F.col("window_start") + F.make_dt_interval(mins=F.lit(size)))


def session_panes(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """One-minute panes per device and referrer."""
    return panes(events, ["device_type", "referrer"], "1 minute", delay, {"sessions": "session_id", "customers": "customer_id"})


def session_metrics_of(parts: DataFrame) -> DataFrame:
    """The columns of :func:`session_metrics` from one-minute panes."""
    return slide(parts, ["device_type", "referrer"], 5, 1, {"unique_sessions": "sessions", "unique_customers": "customers"}).select(
        "window_start", "window_end", "device_type", "referrer", "event_count", "unique_sessions", "unique_customers",
        "product_views", "add_to_carts", "checkouts", percent(F.col("checkouts"), F.col("unique_sessions")).alias("conversion_rate"),
    )


def product_panes(events: DataFrame, delay: str = "30 minutes") -> DataFrame:
    """Five-minute panes per product."""
    return panes(events.where("product_id IS NOT NULL"), ["product_id"], "5 minutes", delay, {"sessions": "session_id"})


def product_trending_of(parts: DataFrame) -> DataFrame:
    """The columns of :func:`product_trending` from five-minute panes."""
    weight = F.col("views") + 3 * F.col("cart_adds") + 10 * F.col("purchases")
    windows = slide(parts, ["product_id"], 15, 5, {"unique_viewers": "sessions"}).withColumnsRenamed(
        {"event_count": "total_events", "product_views": "views", "add_to_carts": "cart_adds", "checkouts": "purchases"})
    return windows.select(
        "window_start", "window_end", "product_id", "total_events", "unique_viewers", "views", "cart_adds", "purchases", weight.cast("int").alias("engagement_score"),
    )


def dashboard_panes(events: DataFrame, delay: str = "5 minutes") -> DataFrame:
    """One-minute panes of all events."""
    return panes(events, [], "1 minute", delay, {"sessions": "session_id", "customers": "customer_id"})


def dashboard_of(parts: DataFrame) -> DataFrame:
    """The columns of :func:`realtime_dashboard` from one-minute panes."""
    return slide(parts, [], 1, 1, {"active_sessions": "sessions", "active_customers": "customers"}).select(
        F.col("window_end").alias("timestamp"), F.col("event_count").alias("events_per_minute"), "active_sessions", "active_customers",
        F.col("checkouts").alias("conversions"),
    )


def distinct_over(parts: DataFrame, unit: str, sketch: str = "customers") -> DataFrame:
    """Estimated distinct values per hour, day or week (any ``date_trunc`` unit), from the sketches of panes: no event is read again."""
    return parts.groupBy(F.date_trunc(unit, "pane_start").alias("period")).agg(
        F.sum("event_count").alias("event_count"), F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias("distinct_values")
    )


def enriched(events: DataFrame, customers: DataFrame, salts: int | None = None) -> DataFrame:
    """Events with the segment, state and lifetime value of their customer (static side, left join).

    Anonymous events have a NULL key and may be many: keys are spread, see :func:`spread_join`.
    """
    profile = customers.select("customer_id", "customer_segment", F.col("state").alias("customer_state"), "lifetime_value")
    joined = spread_join(events, profile, "customer_id", ["event_id"], "left", salts)
    return joined.select(*events.columns, "customer_segment", "customer_state", "lifetime_value")


def closed_windows(events: DataFrame, window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Events per window, for append mode: a window is written once it closes, later rows for it are dropped."""
    return events.withWatermark(TIME, delay).groupBy(F.window(TIME, window)).agg(F.count(F.lit(1)).alias("event_count")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "event_count"
    )


def deduplicated(events: DataFrame, key: str = "event_id", delay: str = "1 hour") -> DataFrame:
    """First arrival of each event; repeats within the delay are dropped and old state is released."""
    return events.withWatermark(TIME, delay).dropDuplicatesWithinWatermark([key])


def view_to_purchase(events: DataFrame, other: DataFrame, hours: int = 1) -> DataFrame:
    """Checkouts with the product views of the same session in the ``hours`` before (stream-stream join).

    The join key includes a time slot as long as the interval; a view is offered to its own and the next
    slot. One very busy session thus spreads over many keys, and every match occurs in exactly one.
    """
    span = hours * 3600

    def slot(ts: str):
        return F.floor(F.unix_seconds(F.col(ts)) / F.lit(span)).cast("bigint")

    views = (
        events.where(F.col("event_type") == VIEW)
        .select(F.col("event_id").alias("view_id"), "session_id", F.col(TIME).alias("view_time"))
        .withWatermark("view_time", f"{hours} hours")
        .withColumn("slot", F.explode(F.array(slot("view_time"), slot("view_time") + 1)))
    )
    checkouts = (
        other.where(F.col("event_type") == CHECKOUT)
        .select(F.col("event_id").alias("purchase_id"), F.col("session_id").alias("buyer_session"), F.col(TIME).alias("purchase_time"))
        .withWatermark("purchase_time", f"{hours} hours")
        .withColumn("buyer_slot", slot("purchase_time"))
    )
    on = F.expr(
        "session_id = buyer_session AND slot = buyer_slot AND purchase_time >= view_time "
        f"AND purchase_time <= view_time + interval {hours} hours"
    )
    return views.join(checkouts, on, "inner").select("session_id", "view_id", "purchase_id", "view_time", "purchase_time")


def session_windows(events: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """Bursts of activity per customer, ended by a pause of ``gap``."""
    return (
        events.where("customer_id IS NOT NULL").withWatermark(TIME, delay)
        .groupBy(F.session_window(TIME, gap), "customer_id")
        .agg(F.count(F.lit(1)).alias("event_count"), _hits(CHECKOUT).alias("checkouts"))
        .select("customer_id", F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"),
                "event_count", "checkouts")
    )


def sessions_by_slot(events: DataFrame, gap_minutes: int = 30, slot_hours: int = 6) -> DataFrame:
    """The rows of :func:`session_windows` for finished tables, with a very busy customer spread over time slots.

    Sessions are first built within (customer, slot of some hours), in parallel. One that starts or ends further than the gap from the
    borders of its slot is final; only the others, at most two per slot, meet their neighbours per customer, where those no
    more than a gap apart become one.
    """
    gap = gap_minutes * 60_000_000
    slot = slot_hours * 3_600_000_000
    if slot < 2 * gap:
        raise ValueError("a slot must hold two gaps")
    micros = F.unix_micros(TIME)
    known = events.where("customer_id IS NOT NULL").where(F.col(TIME).isNotNull())
    parts = (
        known.groupBy("customer_id", F.floor(micros / slot).cast("bigint").alias("_slot"), F.session_window(TIME, f"{gap_minutes} minutes"))
        .agg(
            F.count(F.lit(1)).alias("event_count"), _hits(CHECKOUT).alias("checkouts"),
            # not the bounds of session_window: Spark pushes filters on these below the merging of sessions
            F.min(micros).alias("_start"), (F.max(micros) + gap).alias("_end"),
        )
    )
    open_left, open_right = F.col("_start") - F.col("_slot") * slot <= gap, (F.col("_slot") + 1) * slot <= F.col("_end")
    final, border = parts.where(~(open_left | open_right)), parts.where(open_left | open_right)
    order = Window.partitionBy("customer_id").orderBy("_start")
    apart = F.coalesce(F.col("_start") > F.lag("_end").over(order), F.lit(True))
    numbered = border.withColumn("_new", apart.cast("int")).withColumn("_session", F.sum("_new").over(order))
    joined = numbered.groupBy("customer_id", "_session").agg(
        F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.sum("event_count").alias("event_count"), F.sum("checkouts").alias("checkouts")
    )
    columns = ["customer_id", "_start", "_end", "event_count", "checkouts"]
    return final.select(columns).unionByName(joined.select(columns)).select(
        "customer_id", F.timestamp_micros("_start").alias("session_start"), F.timestamp_micros("_end").alias("session_end"), "event_count", "checkouts"
    )


def metric_anomalies(metrics: DataFrame, time: str = "timestamp", value: str = "events_per_minute", back: int = 60, sigmas: int = 3) -> DataFrame:
    """Minutes whose value lies more than ``sigmas`` standard deviations off the mean of the ``back`` minutes before.

    Batch, over the finished dashboard table. Days are computed side by side: each day also receives the last
    ``back`` minutes of the day before, which only feed the frames. The test is done in whole numbers,
    ``(n*x - S)^2 * (n-1) > sigmas^2 * n * (n*Q - S^2)``, free of rounding.
    """
    minute = F.floor(F.unix_seconds(F.col(time).cast("timestamp")) / 60).cast("bigint")
    day = F.floor(F.col("_m") / 1440)
    frames = (
        metrics.select(time, value).withColumn("_m", minute)
        .withColumn("_day", F.explode(F.array_distinct(F.array(day, F.floor((F.col("_m") + back) / 1440)))))
    )
    w = Window.partitionBy("_day").orderBy("_m").rangeBetween(-back, -1)
    x = F.col(value).cast("decimal(18,0)")
    n, s, q = F.col("_n"), F.col("_s"), F.col("_q")
    off = (n * x - s) * (n * x - s) * (n - 1)
    spread = F.lit(sigmas * sigmas) * n * (n * q - s * s)
    scored = (
        frames.withColumn("_n", F.count(value).over(w).cast("decimal(6,0)"))
        .withColumn("_s", F.sum(value).over(w).cast("decimal(14,0)"))
        .withColumn("_q", F.sum(F.col(value) * F.col(value)).over(w).cast("decimal(18,0)"))
        .where(F.col("_day") == day)
    )
    return scored.select(
        time, value,
        F.try_divide(s.cast("double"), n.cast("double")).alias("mean_before"),
        F.coalesce((n > 1) & (off > spread), F.lit(False)).alias("is_anomaly"),
    )


def flatten_orders(orders: DataFrame) -> DataFrame:
    """One row per order item, address fields as columns; orders without items keep one row."""
    return orders.withColumn("item", F.explode_outer("items")).select(
        "order_id", "customer_id", "order_date", "total_amount", "status", "item.*", "shipping_address.*"
    )
