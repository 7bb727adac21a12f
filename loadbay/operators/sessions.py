"""Activity sessions per employee.

A session ends where the gap to the next input exceeds ``gap_sec``. Numbering rows
with a window per employee would put everything one employee ever did into one
task (``with_sessions`` does so for employees of few rows), so rows are first collapsed into time slots exactly one gap wide. Two inputs
in one slot are less than a gap apart; a session can therefore only begin at the
first input of a slot, and all rows of a slot share one session id. Only the slots
(at most 86400 / gap per employee and day) are ordered per employee.

Rows without an input time come last and open a session each. They are ordered by
prompt time and grouped by half-hour of the prompt and a shard of a hash of the whole row,
as many shards as there are 50 000 undated rows, so that one employee's undated rows are
numbered by many tasks: a group gets a base number from
the running total of group sizes, a row its place inside the group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadbay import schemas as S
from loadbay.functions import columns as C
from loadbay.session import cut

UNDATED_PER_SHARD = 50_000
NO_PROMPT = 2 ** 62

# What identifies a grid row; none of these is ever NULL but the employee.
GRID_KEY = ("employee_id", "dated", "day_no", "hour_no", "slot", "shard")
PLACEMENT = ("dated", "day_no", "hour_no", "slot", "shard", "place")


def time_slot(ts: str | Column, gap_sec: int = S.SESSION_GAP_SEC) -> Column:
    """Index of the gap-wide interval a timestamp falls into."""
    if gap_sec <= 0:
        raise ValueError("gap_sec must be positive")
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", epoch, C.col(ts))
    return F.floor(micros / F.lit(gap_sec * 1_000_000)).cast("bigint")


def _shard(df: DataFrame, rows_per_shard: int, whole: DataFrame | None = None) -> Column:
    """Which shard an undated row belongs to: a hash of the whole row, over as many shards as the
    undated rows of the table ask for."""
    undated = (df if whole is None else whole).where(F.col("input_date").isNull()).agg(F.count("*")).scalar()
    shards = F.ceil(undated / F.lit(float(rows_per_shard))).cast("bigint")
    return F.pmod(_fingerprint(df), F.greatest(shards, F.lit(1))).cast("int")


def _fingerprint(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def with_grid_key(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC,
                  per_shard: int = UNDATED_PER_SHARD, whole: DataFrame | None = None) -> DataFrame:
    """Add the grid key to rows that have calendar columns. ``whole``: the log of which df is a part; its
    undated rows say how many shards there are."""
    dated = F.col("input_date").isNotNull()
    undated_slot = F.coalesce(time_slot("prompt_date"), F.lit(NO_PROMPT))
    return df.withColumns({
        "dated": dated,
        "day_no": F.coalesce(F.unix_date("date"), F.lit(0)),
        "hour_no": F.coalesce("hour", F.lit(0)),
        "slot": F.when(dated, time_slot("input_date", gap_sec)).otherwise(undated_slot),
        "shard": F.when(dated, 0).otherwise(_shard(df, per_shard, whole)),
    })


def activity_grid(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC, whole: DataFrame | None = None) -> DataFrame:
    """One row per employee, date, hour and gap-wide slot (or undated group).

    Daily, weekly and hourly totals and the session numbers all derive from it, so
    the detail rows are aggregated once, on narrow columns.
    """
    return (with_grid_key(df, gap_sec, whole=whole).where(F.col("employee_id").isNotNull())
            .groupBy(*GRID_KEY, "date", "week_number", "hour")
            .agg(F.count("*").alias("rows"),
                 F.count("dialog_type").alias("dialogs"),
                 F.count("response_time_sec").alias("responses"),
                 F.sum(C.micros("response_time_sec")).alias("response_micros"),
                 F.min("input_date").alias("first_input"),
                 F.max("input_date").alias("last_input")))


def _in_order() -> Window:
    return Window.partitionBy("employee_id").orderBy(
        F.asc_nulls_last("first_input"), "slot", "shard")


def gap_flags(grid: DataFrame, gap_sec: int = S.SESSION_GAP_SEC) -> DataFrame:
    """Per grid row: the previous input, the gap in seconds, and the new-session flag."""
    return (grid.withColumn("previous_input", F.lag("last_input").over(_in_order()))
                .withColumn("gap_sec", C.seconds_between("previous_input", "first_input"))
                .withColumn("new_session", F.when(F.col("gap_sec") <= gap_sec, 0).otherwise(1)))


def in_ranges(df: DataFrame, *keys: str) -> DataFrame:
    """df sorted by ``keys`` over range partitions, with ``part`` and ``spot``, which ascend in that order.

    Rows that agree in all keys are spread by a hash of the whole row, so no moment of one employee is a
    partition of its own. The table is cut: the partitions stay what they are on a retry.
    """
    tie = _fingerprint(df)
    ranged = (df.withColumn("__tie", tie).repartitionByRange(*keys, "__tie")
                .sortWithinPartitions(*keys, "__tie").drop("__tie")
                .withColumn("spot", F.monotonically_increasing_id()))
    return cut(ranged, "ranged").withColumn("part", F.shiftright("spot", 33))


def with_previous(ranged: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``name``: the value of the row before, where that row has the same ``key``.

    Inside a partition the row before is found by a window over the partition; the first row takes the
    last one of the partition before from a table of one row a partition.
    """
    inside = Window.partitionBy("part").orderBy("spot")
    before = F.lag(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))).over(inside)
    carried = F.lag("last").over(Window.orderBy("part"))          # one row a partition
    edges = (ranged.groupBy("part").agg(F.max_by(F.struct(F.col(key).alias("k"), F.col(value).alias("v")), "spot").alias("last"))
                   .select(F.col("part").alias("__part"), carried.alias("__carried")))
    last = F.coalesce("__before", "__carried")
    return (ranged.withColumn("__before", before).join(edges, F.col("part") == F.col("__part"))
            .withColumn(name, F.when(last["k"] == F.col(key), last["v"]))
            .drop("__before", "__carried", "__part"))


def row_gaps(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC) -> DataFrame:
    """Dated rows with ``previous_input``, ``gap_sec`` and ``new_session``.

    One scan over ranges of (employee, time): however many rows an employee has in a moment, they
    are spread over partitions and only each partition's last row is carried on.
    """
    dated = df.where(F.col("input_date").isNotNull() & F.col("employee_id").isNotNull())
    return (with_previous(in_ranges(dated, "employee_id", "input_date"), "employee_id", "input_date", "previous_input")
            .withColumn("gap_sec", C.seconds_between("previous_input", "input_date"))
            .withColumn("new_session", F.when(F.col("gap_sec") <= gap_sec, 0).otherwise(1))
            .drop("spot", "part"))


def number_grid(grid: DataFrame, gap_sec: int = S.SESSION_GAP_SEC) -> DataFrame:
    """``session_base``: the session id of a dated grid row (1, 2, ... per employee);
    for an undated group the number of sessions before it."""
    opened = F.when(F.col("dated"), F.col("new_session")).otherwise(F.col("rows"))
    running = _in_order().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum(opened).over(running)
    return gap_flags(grid, gap_sec).withColumn(
        "session_base", F.when(F.col("dated"), upto).otherwise(upto - F.col("rows")).cast("bigint"))


def placed(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC, whole: DataFrame | None = None) -> DataFrame:
    """Rows with grid key and ``place``: 0 if dated, else 1, 2, ... in the group."""
    keyed = with_grid_key(df, gap_sec, whole=whole)
    group = Window.partitionBy(*GRID_KEY).orderBy("prompt_date", "fingerprint")
    undated = (keyed.where(F.col("input_date").isNull() & F.col("employee_id").isNotNull())
                    .withColumn("fingerprint", _fingerprint(df))
                    .withColumn("place", F.row_number().over(group).cast("bigint"))
                    .drop("fingerprint"))
    # dated rows, and rows that get no session for want of an employee
    dated = (keyed.where(F.col("input_date").isNotNull() | F.col("employee_id").isNull())
                  .withColumn("place", F.lit(0).cast("bigint")))
    return dated.unionByName(undated)


def with_sessions(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC, whole: DataFrame | None = None) -> DataFrame:
    """``session_id`` as by ``sessionize``, from all rows of an employee in order; for employees whose rows one
    task can hold. Rows without an employee are not numbered."""
    undated = F.col("input_date").isNull()
    keyed = with_grid_key(df, gap_sec, whole=whole).withColumn("fingerprint", F.when(undated, _fingerprint(df)))
    order = Window.partitionBy("employee_id").orderBy(
        F.asc_nulls_last("input_date"), F.when(undated, F.col("slot")), "shard", F.when(undated, F.col("prompt_date")),
        "fingerprint")
    gap = C.seconds_between(F.lag("input_date").over(order), "input_date")
    upto = F.sum("opened").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (keyed.withColumn("opened", F.when(undated, 1).when(gap <= gap_sec, 0).otherwise(1))
            .withColumn("session_id", F.when(F.col("employee_id").isNotNull(), upto))
            .select(*df.columns, "session_id"))


def sessionize(df: DataFrame, gap_sec: int = S.SESSION_GAP_SEC) -> DataFrame:
    """Add ``session_id`` to rows with calendar and response columns."""
    bases = number_grid(activity_grid(df, gap_sec), gap_sec).select(*GRID_KEY, "session_base")
    return (placed(df, gap_sec).join(bases, list(GRID_KEY), "left")
            .withColumn("session_id", F.col("session_base") + F.col("place"))
            .drop("session_base", *PLACEMENT))
