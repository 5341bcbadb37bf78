"""Metric readings over time: rates, last values, sampling, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tideline.operators.joins import join_small

MICROS = 1_000_000
# Readings of one series that a task may sort.
CHUNK_ROWS = 5_000_000
MAX_CHUNK_SECONDS = 30 * 86_400
# Readings that a task gets; every sort of theirs takes about a kilobyte a reading in all.
TASK_ROWS = 200_000
# Steps that readings are counted in to size chunks; no chunk is shorter.
STEP_SECONDS = 10


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def chunk_for(readings: DataFrame, name: str = "name", ts: str = "ts") -> int:
    """Chunk length that keeps the busiest series near ``CHUNK_ROWS`` rows per chunk, whatever the window.

    One counting pass over short steps, combined before the shuffle.
    """
    return _chunk_and_rows(readings, name, ts)[0]


def _chunk_and_rows(readings: DataFrame, name: str, ts: str) -> tuple[int, int]:
    step = F.floor(micros(F.col(ts)) / (STEP_SECONDS * MICROS))
    busiest, rows = readings.groupBy(name, step.alias("step")).count().agg(F.max("count"), F.sum("count")).first()
    return int(min(max(1, CHUNK_ROWS // (busiest or 1)) * STEP_SECONDS, MAX_CHUNK_SECONDS)), rows or 0


def _chunks_per_window(seconds: int, chunk_seconds: int) -> int:
    """Least number of equal chunks of whole microseconds, of at most ``chunk_seconds``, that make up a window."""
    k = -(-seconds // chunk_seconds)
    while seconds * MICROS % k:
        k += 1
    return k


def _windows(readings: DataFrame, seconds: int, name: str, ts: str, value: str, tie: str | None, chunk_seconds: int | None) -> DataFrame:
    """Each reading with what its trailing window of ``seconds`` holds, both edges included.

    ``total``: the sum of all rises; ``after``: without that of the first reading; ``n``, ``first_us``,
    ``first_value``. A reading below the one before is a restart, whose rise is the reading itself.

    Time is cut into chunks, ``k`` of which make up a window. A window then is the end of the chunk ``k`` before,
    the whole chunks between, and the start of its own chunk. Each chunk is therefore also sent ``k`` chunks on,
    its times moved by a window: there a running sum from the last time back meets the running sum from the first
    time on. Sums are only ever added to, so an infinite or very large reading counts as long as it is in the
    window and leaves no trace afterwards. The readings are shuffled once, by series and chunk.
    """
    chunk, n = _chunk_and_rows(readings, name, ts)
    k = _chunks_per_window(seconds, min(seconds, chunk_seconds or chunk))
    chunk_us = seconds * MICROS // k
    # A series without a name is one too, and joins would lose a key that is null.
    keys = ["series", "chunk"]
    known = readings.where(F.col(value).isNotNull()).select(
        F.struct(F.col(name).alias("name")).alias("series"), F.col(ts).alias("ts"), F.col(value).alias("v"), (F.col(tie) if tie else F.lit(0)).alias("tie"), micros(F.col(ts)).alias("us")
    ).withColumn("chunk", F.floor(F.col("us") / chunk_us).cast("bigint"))

    # One row per series and chunk: small enough to look back over the whole series.
    ends = known.groupBy(*keys).agg(F.max_by("v", F.struct("us", "tie")).alias("ended"))
    by_series = Window.partitionBy("series").orderBy("chunk")
    carried = ends.select(*keys, F.lag("ended").over(by_series).alias("carried"))
    sides = F.array(F.struct(F.col("chunk"), F.lit(False).alias("old")), F.struct((F.col("chunk") + k).alias("chunk"), F.lit(True).alias("old")))
    met = carried.select("series", "carried", F.inline(sides)).groupBy(*keys).agg(
        F.max(F.when(~F.col("old"), F.struct("carried"))).alias("now"), F.max(F.when(F.col("old"), F.struct("carried"))).alias("then")
    )

    now = F.struct(F.col("chunk"), F.lit(False).alias("old"), F.col("us").alias("at"))
    then = F.struct((F.col("chunk") + k).alias("chunk"), F.lit(True).alias("old"), (F.col("us") + seconds * MICROS).alias("at"))
    # Dealt out before the join, so that the small side is the one that comes to the readings. A number of tasks that is said
    # is kept, where others are merged until there are as many as cores, whatever they hold.
    tasks = -(-2 * n // TASK_ROWS)
    many = tasks > readings.sparkSession.sparkContext.defaultParallelism
    by = [tasks, *keys] if many else keys
    # Joins take the session's number of tasks unless both sides say the same.
    met = met.repartition(*by) if many else met
    dealt = known.select("series", "ts", "v", "tie", "us", F.inline(F.array(now, then))).repartition(*by).join(met, keys)
    within = Window.partitionBy(*keys, "old").orderBy("us", "tie")
    previous = F.lag("v").over(within)
    before = F.when(F.row_number().over(within) > 1, previous).otherwise(F.when(F.col("old"), F.col("then.carried")).otherwise(F.col("now.carried")))
    rises = dealt.withColumn("before", before).withColumn("first", F.row_number().over(within) == 1).withColumn(
        "rise",
        F.when(F.col("before").isNull() | (F.col("v") == F.col("before")), F.lit(0)).when(F.col("v") < F.col("before"), F.col("v")).otherwise(F.col("v") - F.col("before")),
    )
    later = Window.partitionBy(*keys, "old").orderBy(F.desc("us"), F.desc("tie")).rowsBetween(Window.unboundedPreceding, -1)
    rises = rises.withColumn("later", F.when(F.col("old"), F.sum("rise").over(later)))

    def if_old(x: Column) -> Column:
        return F.when(F.col("old"), x)

    def if_now(x: Column) -> Column:
        return F.when(~F.col("old"), x)

    back = Window.partitionBy(*keys).orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, 0)
    on = Window.partitionBy(*keys).orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    seen = rises.select(
        *keys, "ts", "v", "tie", "us", "old", "rise", "first",
        F.struct(
            F.count(if_old(F.lit(1))).over(back).alias("n"),
            F.sum(if_old(F.col("rise"))).over(back).alias("total"),
            F.min(if_old(F.struct("us", "tie", "v", "later"))).over(back).alias("first"),
        ).alias("tail"),
        F.struct(
            F.count(if_now(F.lit(1))).over(on).alias("n"),
            F.sum(if_now(F.col("rise"))).over(on).alias("total"),
            F.sum(if_now(F.when(~F.col("first"), F.col("rise")))).over(on).alias("after"),
            F.min(if_now(F.struct("us", "tie", "v"))).over(on).alias("first"),
        ).alias("head"),
    )
    rows = seen.where("not old")
    zero = F.lit(0)
    if k > 1:
        # What lies between, from one row per chunk: the chunks in order, so that the first one's first rise can be left out.
        whole = rises.where("not old").groupBy(*keys).agg(
            F.count("*").alias("n"), F.sum("rise").alias("total"), F.sum(F.when(~F.col("first"), F.col("rise"))).alias("after"),
            F.min(F.struct("us", "tie", "v")).alias("first"),
        )
        between = Window.partitionBy("series").orderBy("chunk").rangeBetween(-(k - 1), -1)
        listed = whole.select(*keys, F.array_sort(F.collect_list(F.struct("chunk", "n", "total", "after", "first")).over(between)).alias("mid"))
        rows = rows.join(listed.repartition(*by) if many else listed, keys)
        mid = F.col("mid")
        number = F.aggregate(mid, F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
        whole_sum = F.when(F.size(mid) > 0, F.aggregate(F.slice(mid, 2, F.greatest(F.size(mid) - 1, F.lit(0))), F.get(mid, 0)["total"], lambda a, x: (a + x["total"]).cast(_type_of(whole, "total"))))
        rest_sum = F.when(
            F.size(mid) > 0,
            F.aggregate(F.slice(mid, 2, F.greatest(F.size(mid) - 1, F.lit(0))), F.coalesce(F.get(mid, 0)["after"], zero.cast(_type_of(whole, "after"))), lambda a, x: (a + x["total"]).cast(_type_of(whole, "after"))),
        )
        rows = rows.withColumn("mid", F.struct(number.alias("n"), whole_sum.alias("total"), rest_sum.alias("after"), F.get(mid, 0)["first"].alias("first")))
        has_mid, mid_n, mid_total, mid_after, mid_first = F.col("mid.n") > 0, F.col("mid.n"), F.coalesce("mid.total", zero), F.coalesce("mid.after", zero), F.col("mid.first")
    else:
        has_mid, mid_n, mid_total, mid_after, mid_first = F.lit(False), zero, zero, zero, F.lit(None)
    head_total, head_after = F.coalesce("head.total", zero), F.coalesce("head.after", zero)
    has_tail = F.col("tail.n") > 0
    after = (
        F.when(has_tail, F.coalesce("tail.first.later", zero) + mid_total + head_total).when(has_mid, mid_after + head_total).otherwise(head_after)
    )

    def first(field: str) -> Column:
        between_ = F.when(has_mid, mid_first[field]) if k > 1 else F.lit(None)
        return F.coalesce(F.when(has_tail, F.col(f"tail.first.{field}")), between_, F.col(f"head.first.{field}"))

    return rows.select(
        F.col("series.name").alias(name), F.col("ts").alias(ts), F.col("v").alias(value), *([F.col("tie").alias(tie)] if tie else []), "us",
        (F.coalesce("tail.total", zero) + mid_total + head_total).alias("total"), after.alias("after"),
        (F.col("tail.n") + mid_n + F.col("head.n")).alias("n"), first("us").alias("first_us"), first("v").alias("first_value"),
    )


def _type_of(frame: DataFrame, column: str) -> str:
    return frame.schema[column].dataType.simpleString()


def trailing_rate(
    readings: DataFrame, seconds: int, name: str = "name", ts: str = "ts", value: str = "value",
    tie: str | None = None, chunk_seconds: int | None = None,
) -> DataFrame:
    """Per-second increase over the trailing ``seconds``, counter resets included.

    A reading below the one before counts as a restart from zero; a reading exactly as old as the window still
    counts. Exact for whole and decimal values; infinite ones and NaN leave the rate with the window. No
    extrapolation to the edges of the window.
    """
    rows = _windows(readings, seconds, name, ts, value, tie, chunk_seconds)
    kept = [name, ts, value, *([tie] if tie else [])]
    return rows.select(*kept, (F.col("total").cast("double") / seconds).alias("rate"))


# A gap to the edge of the window of up to this many mean gaps is filled, a longer one by half a mean gap.
FILL_UP_TO, ELSE_FILL = 1.1, 0.5


def extrapolated_rate(
    readings: DataFrame, seconds: int, name: str = "name", ts: str = "ts", value: str = "value",
    tie: str | None = None, chunk_seconds: int | None = None,
) -> DataFrame:
    """Rate of a counter as dashboards show it: the increase between the first and the last reading of the window,
    carried on to the window's edges.

    The window ends at the reading. It is filled back to its start if the first reading is about a mean gap away at
    most, else by half a mean gap, and never to before the counter would have been zero. NULL with fewer than two
    readings, or if all are of one time.
    """
    rows = _windows(readings, seconds, name, ts, value, tie, chunk_seconds)
    increase, first = F.col("after").cast("double"), F.col("first_value").cast("double")
    rows = rows.select(
        name, ts, value, *([tie] if tie else []), "n", increase.alias("increase"), first.alias("first"),
        ((F.col("us") - F.col("first_us")) / F.lit(float(MICROS))).alias("sampled"),
        ((F.col("first_us") - (F.col("us") - seconds * MICROS)) / F.lit(float(MICROS))).alias("to_start"),
    )
    gap = F.col("sampled") / (F.col("n") - 1)
    filled = F.when(F.col("to_start") >= gap * FILL_UP_TO, gap * ELSE_FILL).otherwise(F.col("to_start"))
    to_zero = F.when((F.col("increase") > 0) & (F.col("first") >= 0), F.col("sampled") * (F.col("first") / F.col("increase")))
    # ``least`` skips a missing bound.
    factor = (F.col("sampled") + F.least(filled, to_zero)) / F.col("sampled") / F.lit(float(seconds))
    rate = F.when((F.col("n") >= 2) & (F.col("sampled") > 0), F.col("increase") * factor)
    return rows.select(name, ts, value, *([tie] if tie else []), rate.alias("rate"))


def _newest(value: str, ts: str, tie: str | None) -> Column:
    """The last value; of equal times the one with the larger ``tie``, or else the larger value."""
    return F.max_by(value, F.struct(ts, tie or value)).alias(value)


def last_reading(
    readings: DataFrame, name: str = "name", ts: str = "ts", value: str = "value", tie: str | None = None
) -> DataFrame:
    known = readings.where(F.col(value).isNotNull())
    return known.groupBy(name).agg(_newest(value, ts, tie), F.max(ts).alias(ts))


def recent(readings: DataFrame, interval: str, ts: str = "ts") -> DataFrame:
    """Readings of the trailing interval before the newest one."""
    newest = readings.agg(F.max(ts)).scalar()
    return readings.where(F.col(ts) >= newest - F.expr(f"interval {interval}"))


def resample(
    readings: DataFrame, step: str, name: str = "name", ts: str = "ts", value: str = "value", tie: str | None = None
) -> DataFrame:
    """Last reading of each series in each step."""
    return (
        readings.groupBy(name, F.window(ts, step).alias("w"))
        .agg(_newest(value, ts, tie))
        .select(name, F.col("w.start").alias("step_start"), value)
    )


def sample_stats(readings: DataFrame, groups: list[str], value: str = "value") -> DataFrame:
    """Mean, least and largest of the readings above zero; 0 when there is none."""
    positive = F.when(F.col(value) > 0, F.col(value))
    mean = F.sum(positive).cast("double") / F.nullif(F.count(positive), F.lit(0))
    return readings.groupBy(*groups).agg(
        F.coalesce(F.round(mean, 3), F.lit(0.0)).alias("mean_value"),
        F.coalesce(F.min(positive).cast("double"), F.lit(0.0)).alias("min_value"),
        F.coalesce(F.max(positive).cast("double"), F.lit(0.0)).alias("max_value"),
        F.count(positive).cast("bigint").alias("n"),
    )


# ---- fixed values: metric, lower edge of the middle and of the far band, colours from low to high ----
BANDS = [
    ("latency_p50_s", 3.0, 6.0, "green", "yellow", "red"),
    ("latency_p99_s", 5.0, 8.0, "green", "yellow", "red"),
    ("throughput_tps", 20.0, 40.0, "red", "yellow", "green"),
    ("read_p99_ms", 1.0, 3.0, "green", "yellow", "red"),
    ("sync_rate_pct", 90.0, 100.0, "red", "yellow", "green"),
    ("latency_ms", 1000.0, 2000.0, "green", "yellow", "red"),
    ("lag", 1.0, 1.0, "green", "red", "red"),
    ("in_sync", 1.0, 1.0, "red", "green", "green"),
]
IN_SYNC_TEXT = {1: "IN SYNC", 0: "OUT OF SYNC"}
# ---- end of fixed values ----


def bands(spark: SparkSession, rows=BANDS) -> DataFrame:
    return spark.createDataFrame(
        rows, "name string, middle_from double, far_from double, low string, middle string, far string"
    )


def in_bands(readings: DataFrame, band_table: DataFrame, name: str = "name", value: str = "value") -> DataFrame:
    """Colour of each reading; NULL for a metric without thresholds, which are data."""
    far = F.col(value) >= F.col("far_from")
    middle = F.col(value) >= F.col("middle_from")
    colour = F.when(far, F.col("far")).when(middle, F.col("middle")).otherwise(F.col("low"))
    joined = join_small(readings, band_table, [name], "left")
    return joined.withColumn("band", F.when(F.col("low").isNotNull(), colour)).drop(
        "middle_from", "far_from", "low", "middle", "far"
    )


def sync_text(in_sync: Column) -> Column:
    return F.when(in_sync == 1, IN_SYNC_TEXT[1]).otherwise(IN_SYNC_TEXT[0])


def to_millis(seconds: Column) -> Column:
    return seconds * 1000
