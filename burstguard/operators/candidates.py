"""The match tests alone, without consuming: every row that completes a match.

Useful by itself and as a cheap screen. Each test looks back one window at most. For counts and pairs a window is cut into
``SUBS`` sub-slots; rows are sorted and windowed inside theirs only, so that one key's rows inside one window are spread
over many tasks. What a sub-slot needs to know of those before it is a small state for each: the last times. These states
are carried along among themselves, a row per key and sub-slot. Payments are counted, which such states make dear (five
times the work on the test tables): their rows are windowed per (key, slot of a few windows), a slot also seeing the rows
one window before it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SUBS = 32
# Sub-slots whose states are carried along in one group, in windows.
GROUP_WINDOWS = 8


def _floor_div(value: Column, width: int) -> Column:
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


class _Cut:
    """Sub-slots for one key column and window."""

    def __init__(self, key: str, window_ms: int):
        self.key, self.width = key, max(1, window_ms // SUBS)
        # so many sub-slots before its own can hold rows of a row's window
        self.reach = -(-window_ms // self.width) + 1
        self.group = self.reach * GROUP_WINDOWS
        self.inside = Window.partitionBy(key, "_sub").orderBy("timestamp", "seq")
        self.upto = self.inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def sub(self, time: str = "timestamp") -> Column:
        return _floor_div(F.col(time).cast("bigint"), self.width)

    def placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_sub", self.sub())

    def grouped(self, states: DataFrame) -> DataFrame:
        """States in their group of sub-slots and, within reach of its end, in the next one too (``_group``)."""
        own = _floor_div(F.col("_sub"), self.group)
        reached = _floor_div(F.col("_sub") + self.reach, self.group)
        return states.withColumn("_group", F.explode(F.sequence(own, reached)))

    def carried(self, states: DataFrame, **values: Column) -> DataFrame:
        """For every sub-slot that has a state: aggregates of the states before it, as far as a window reaches."""
        before = Window.partitionBy(self.key, "_group").orderBy("_sub").rangeBetween(-self.reach, -1)
        own = F.col("_group") == _floor_div(F.col("_sub"), self.group)
        return self.grouped(states).withColumns({n: v.over(before) for n, v in values.items()}).where(own).select(
            self.key, "_sub", *values
        )


def count_candidates(rows: DataFrame, key: str, threshold: int, window_ms: int) -> DataFrame:
    """Rows that are the ``threshold``-th of their key within the window; adds ``firstTimestamp``."""
    cut = _Cut(key, window_ms)
    placed = cut.placed(rows)
    back = threshold - 1
    if back == 0:
        return rows.withColumn("firstTimestamp", F.col("timestamp"))
    last = Window.partitionBy(key, "_sub").orderBy(F.desc("timestamp"))
    states = (
        placed.select(key, "_sub", "timestamp").withColumn("_n", F.row_number().over(last)).where(F.col("_n") <= back)
        .groupBy(key, "_sub").agg(F.collect_list("timestamp").alias("_times"))
    )
    # times before the sub-slot, the latest first
    earlier = cut.carried(states, _lists=F.collect_list("_times")).select(
        key, "_sub", F.slice(F.sort_array(F.flatten("_lists"), False), 1, back).alias("_earlier")
    )
    place = F.row_number().over(cut.inside)
    inside = F.lag("timestamp", back).over(cut.inside)
    return (
        placed.withColumns({"_place": place, "_inside": inside})
        .join(earlier, [key, "_sub"], "left")
        .withColumn("firstTimestamp", F.coalesce("_inside", F.get("_earlier", F.lit(back) - F.col("_place"))))
        .where(F.col("timestamp") - F.col("firstTimestamp") <= window_ms)
        .select(*rows.columns, "firstTimestamp")
    )


def pair_candidates(rows: DataFrame, key: str, window_ms: int) -> DataFrame:
    """``second`` rows with a ``first`` row of their key within the window before them (by ``role``);
    adds the time of the latest one."""
    cut = _Cut(key, window_ms)
    placed = cut.placed(rows)
    first = F.when(F.col("role") == "first", F.col("timestamp"))
    states = placed.groupBy(key, "_sub").agg(F.max(first).alias("_first"))
    earlier = cut.carried(states, _earlier=F.max("_first"))
    return (
        placed.withColumn("_inside", F.last(first, ignorenulls=True).over(cut.upto))
        .where(F.col("role") == "second")
        .join(earlier, [key, "_sub"], "left")
        .withColumn("firstTimestamp", F.coalesce("_inside", "_earlier"))
        .where(F.col("timestamp") - F.col("firstTimestamp") <= window_ms)
        .select(*rows.columns, "firstTimestamp")
    )


# Slots of payment candidates, in windows.
SLOT_WINDOWS = 8


def in_slots(rows: DataFrame, window_ms: int) -> DataFrame:
    """Each row in its slot and, within a window of the border, in the next; ``_core`` marks its own."""
    span = window_ms * SLOT_WINDOWS
    own = F.expr(f"timestamp div {span}")
    reached = F.expr(f"(timestamp + {window_ms}) div {span}")
    return (
        rows.withColumn("_own", own)
        .withColumn("_slot", F.explode(F.sequence(own, reached)))
        .withColumn("_core", F.col("_slot") == F.col("_own"))
        .drop("_own")
    )


def with_lookbacks(rows: DataFrame, key: list[str]) -> DataFrame:
    """Adds, per key in (timestamp, seq) order: ``rn``; the last first/login row up to here
    (``first1``) and the last login from another ip than that (``first2``); and the number of
    small payments up to here (``smalls``)."""
    w = Window.partitionBy(*key).orderBy("timestamp", "seq")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    anchor = F.when(
        (F.col("role") == "first") | ((F.col("role") == "login") & F.coalesce(F.col("ip") != "", F.lit(False))),
        F.struct(F.col("rn").alias("rn"), F.col("timestamp").alias("t"), F.lower("ip").alias("ip")),
    )
    small = (F.col("role") == "small").cast("int")
    rows = rows.withColumn("rn", F.row_number().over(w)).withColumn("smalls", F.sum(small).over(upto).cast("int"))
    rows = rows.withColumn("first1", F.last(anchor, ignorenulls=True).over(upto))
    before = F.lag("first1").over(w)
    turned = F.when((F.col("first1.rn") == F.col("rn")) & (F.col("first1.ip") != before["ip"]), before)
    return (
        rows.withColumn("_turned", turned)
        .withColumn("first2", F.last("_turned", ignorenulls=True).over(upto))
        .drop("_turned")
    )


def remote_login() -> Column:
    """The latest login from another ip than this row's, null when the row has no ip."""
    ip = F.lower("ip")
    return F.when(F.coalesce(ip != "", F.lit(False)), F.when(F.col("first1.ip") != ip, F.col("first1")).otherwise(
        F.when(F.col("first1").isNotNull(), F.col("first2"))
    ))


def payment_candidates(rows: DataFrame, key: str, threshold: int, window_ms: int) -> DataFrame:
    """``large`` payments with enough ``small`` ones and a ``login`` from another ip in the window
    before them; adds the number of small payments and the time of the latest such login."""
    slotted = with_lookbacks(in_slots(rows, window_ms), [key, "_slot"])
    older = Window.partitionBy(key, "_slot").orderBy("timestamp").rangeBetween(
        Window.unboundedPreceding, -(window_ms + 1)
    )
    before_window = F.coalesce(F.sum((F.col("role") == "small").cast("int")).over(older), F.lit(0))
    return (
        slotted.withColumn("smallPayments", F.col("smalls") - before_window)
        .withColumn("loginTimestamp", remote_login()["t"])
        .where(
            F.col("_core")
            & (F.col("role") == "large")
            & (F.col("smallPayments") >= threshold)
            & (F.col("timestamp") - F.col("loginTimestamp") <= window_ms)
        )
        .drop("_slot", "_core", "rn", "smalls", "first1", "first2")
    )
