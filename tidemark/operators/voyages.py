"""From in-port pings to sessions, stays, journeys and origin-destination counts.

Input rows carry ``mmsi, vessel_name, ts, port_id, port_name``. Within a vessel the order is
(ts, port_id, vessel_name), so results do not depend on how ties happen to arrive.

One vessel id may hold a large share of all rows (0 and other placeholder ids do), so no window ranges
over all pings or all stays of a vessel. Pings are windowed per (vessel, time slice); each slice is summarised
in one row; windows over those summaries give what each slice inherits from the earlier ones. Slices are six hours
wide, and one that holds too many pings is cut further at quantiles of its own times (``crowded_slices``), so a
slice is bounded whatever the vessel. Stays are windowed per (vessel, block of sessions) in the same manner.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.functions.columns import put_aside
from tidemark.functions.temporal import epoch_seconds, seconds_between
from tidemark.session import stored

SLICE_SECONDS = 6 * 3600
#: Pings of a vessel and slice beyond which the slice is cut, and the most slices that are.
SLICE_ROWS = 100_000
MOST_CROWDED = 20_000
#: Pieces that one slice is cut into at most.
MOST_PIECES = 1024
#: Sessions of a vessel whose stays are windowed together.
BLOCK_SESSIONS = 1024
MIN_STAY_SECONDS = 15 * 60
_NO_KEY = -(2**63)
_HELPERS = "_(vessel|slice|part|borders|at|block|prev_port|prev_ts|breaks?|base|opens|in_port|in_ts|n_breaks|(first|last)(_(port|ts))?)"


@dataclass(frozen=True)
class Slices:
    """How pings are cut: the width, and the borders inside crowded slices ``_vessel, _slice, _borders`` if there are any."""

    seconds: int = SLICE_SECONDS
    crowded: DataFrame | None = None

    @property
    def keys(self) -> list[str]:
        return ["_vessel", "_slice"] + (["_part"] if self.crowded is not None else [])

    def inside(self):
        return Window.partitionBy(*self.keys).orderBy("ts", "port_id", "vessel_name")

    def along(self):
        return Window.partitionBy("_vessel").orderBy(*self.keys[1:])

    def cut(self, in_port: DataFrame) -> DataFrame:
        """Non-NULL grouping keys: NULL vessels form one group and NULL times come first, as in a plain window."""
        no_key = F.lit(_NO_KEY).cast("bigint")
        cut = in_port.withColumns(
            {
                "_vessel": F.coalesce(F.col("mmsi").cast("bigint"), no_key),
                "_slice": F.coalesce(F.floor(epoch_seconds(F.col("ts")) / F.lit(self.seconds)), no_key),
            }
        )
        if self.crowded is None:
            return cut
        # at most MOST_CROWDED rows, with two borders each on average
        known = cut.join(F.broadcast(self.crowded), ["_vessel", "_slice"], "left")
        below = F.size(F.filter("_borders", lambda border: border <= _place(in_port)))
        return known.withColumn("_part", F.coalesce(F.greatest(below, F.lit(0)), F.lit(0))).drop("_borders")


def _place(in_port: DataFrame) -> Column:
    """Where a ping stands in its slice: by time, and without a time by its port, if ports are numbers."""
    by_time = F.unix_micros(F.col("ts").cast("timestamp"))
    if "port_id" in in_port.columns and isinstance(in_port.schema["port_id"].dataType, NumericType):
        return F.coalesce(by_time, F.col("port_id").cast("bigint"))
    return by_time


def crowded_slices(pings: DataFrame, slice_seconds: int = SLICE_SECONDS, most: int = SLICE_ROWS) -> DataFrame | None:
    """Borders that cut the slices of more than ``most`` pings into pieces of about as many, or None without such slices.

    Counts are one aggregate over ``mmsi, ts`` (and ``port_id`` if there is one), summed map side first; only crowded
    slices are looked at again, for quantiles of their times, or of their ports where times are NULL. No more than
    ``MOST_CROWDED`` slices are cut: if more are crowded, ``most`` grows until that many hold all rows beyond it.
    Rows that agree in time and port stay together.
    """
    columns = [c for c in ("mmsi", "ts", "port_id") if c in pings.columns]
    keyed = Slices(slice_seconds).cut(pings.select(*columns)).withColumn("_at", _place(pings))
    counts = keyed.groupBy("_vessel", "_slice").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    rows, largest = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("n")).first()
    if not rows:
        return None
    most = max(most, -(-rows // MOST_CROWDED))
    pieces = min(MOST_PIECES, -(-largest // most))
    crowded = stored(counts.where(F.col("n") > most).select("_vessel", "_slice"), "crowded-slices")
    quantiles = F.percentile_approx("_at", [i / pieces for i in range(1, pieces)], 16 * pieces)
    borders = keyed.join(F.broadcast(crowded), ["_vessel", "_slice"]).groupBy("_vessel", "_slice").agg(quantiles.alias("_borders"))
    return stored(borders.withColumn("_borders", F.array_distinct("_borders")), "slice-borders")


def _is_break(prev_port: Column, port: Column, prev_ts: Column, ts: Column, max_gap_seconds: int | None) -> Column:
    moved = prev_port != port
    if max_gap_seconds is None:
        return moved
    return moved | F.coalesce(seconds_between(prev_ts, ts) > F.lit(max_gap_seconds), F.lit(False))


def _with_local_breaks(sliced: DataFrame, slices: Slices, max_gap_seconds: int | None) -> DataFrame:
    """Previous port and time inside the slice, and the breaks seen since the slice began."""
    window = slices.inside()
    local = sliced.withColumns({"_prev_port": F.lag("port_id").over(window), "_prev_ts": F.lag("ts").over(window)})
    is_break = _is_break(F.col("_prev_port"), F.col("port_id"), F.col("_prev_ts"), F.col("ts"), max_gap_seconds)
    local = local.withColumn("_break", F.coalesce(is_break, F.lit(False)).cast("bigint"))
    so_far = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return local.withColumn("_breaks", F.sum("_break").over(so_far))


def _inherited(summaries: DataFrame, slices: Slices, max_gap_seconds: int | None) -> DataFrame:
    """Per slice: what the previous slice ended with, and the number of sessions begun before it.

    ``_base`` counts the sessions of all earlier slices plus one if this slice opens a new one, so that
    session id = _base + breaks since the slice began.
    """
    window = slices.along()
    chained = summaries.withColumns(
        {"_in_port": F.lag("_last_port").over(window), "_in_ts": F.lag("_last_ts").over(window)}
    )
    is_break = _is_break(F.col("_in_port"), F.col("_first_port"), F.col("_in_ts"), F.col("_first_ts"), max_gap_seconds)
    opens = (F.col("_in_port").isNull() | is_break).cast("bigint")
    chained = chained.withColumn("_opens", opens)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    begun = F.sum(F.col("_opens") + F.col("_n_breaks")).over(earlier)
    return chained.select(
        *slices.keys,
        "_in_port",
        "_in_ts",
        "_opens",
        (F.coalesce(begun, F.lit(0)) + F.col("_opens")).alias("_base"),
    )


def sessionize(
    in_port: DataFrame, max_gap_seconds: int | None = None, slice_seconds: int = SLICE_SECONDS, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Append ``prev_port, prev_time, is_new_session, session_id``; columns of these names are replaced.

    A session is a maximal run of pings in the same port; ``max_gap_seconds`` also ends it after silence. The pings are
    computed once and stored; from there they are shuffled with the columns that are asked for, and once more with the
    four that the slices' summaries need.
    """
    made = ("prev_port", "prev_time", "is_new_session", "session_id")
    plain, _, restored = put_aside(in_port.drop(*made), _HELPERS)
    pings = stored(plain, "in-port-pings")
    slices = Slices(slice_seconds, crowded_slices(pings, slice_seconds, slice_rows))
    local = _with_local_breaks(slices.cut(pings), slices, max_gap_seconds)
    order = F.struct("ts", "port_id", "vessel_name")
    summaries = local.groupBy(*slices.keys).agg(
        F.min_by("port_id", order).alias("_first_port"),
        F.max_by("port_id", order).alias("_last_port"),
        F.min("ts").alias("_first_ts"),
        F.max("ts").alias("_last_ts"),
        F.sum("_break").alias("_n_breaks"),
    )
    joined = local.join(_inherited(summaries, slices, max_gap_seconds), slices.keys)
    at_start = F.col("_prev_port").isNull()
    return restored(
        joined.select(
            *plain.columns,
            F.when(at_start, F.col("_in_port")).otherwise(F.col("_prev_port")).alias("prev_port"),
            F.when(at_start, F.col("_in_ts")).otherwise(F.col("_prev_ts")).alias("prev_time"),
            F.when(at_start, F.col("_opens")).otherwise(F.col("_break")).cast("int").alias("is_new_session"),
            (F.col("_base") + F.col("_breaks")).alias("session_id"),
        )
    )


def stay_blocks(
    in_port: DataFrame,
    min_stay_seconds: int = MIN_STAY_SECONDS,
    max_gap_seconds: int | None = None,
    slice_seconds: int = SLICE_SECONDS,
    crowded: DataFrame | None = None,
    collapse: bool = True,
) -> DataFrame:
    """The rows of ``port_stays`` with ``_block``, dealt by (mmsi, _block): what ``journeys`` needs to go on without a shuffle."""
    slices = Slices(slice_seconds, crowded)
    pings = in_port.select("mmsi", "vessel_name", "ts", "port_id", "port_name")
    pings = pings.distinct() if collapse else pings
    local = _with_local_breaks(slices.cut(pings), slices, max_gap_seconds)
    runs = local.groupBy(*slices.keys, "_breaks", "mmsi", "vessel_name", "port_id", "port_name").agg(
        F.min("ts").alias("_first"), F.max("ts").alias("_last")
    )
    summaries = runs.groupBy(*slices.keys).agg(
        F.min_by("port_id", "_breaks").alias("_first_port"),
        F.max_by("port_id", "_breaks").alias("_last_port"),
        F.min("_first").alias("_first_ts"),
        F.max("_last").alias("_last_ts"),
        F.max("_breaks").alias("_n_breaks"),
    )
    joined = runs.join(_inherited(summaries, slices, max_gap_seconds), slices.keys).withColumn("session_id", F.col("_base") + F.col("_breaks"))
    blocks = joined.withColumn("_block", F.expr(f"session_id DIV {BLOCK_SESSIONS}"))
    blocks = blocks.select("mmsi", "vessel_name", "port_id", "port_name", "session_id", "_block", "_first", "_last").repartition("mmsi", "_block")
    stays = blocks.groupBy("mmsi", "vessel_name", "port_id", "port_name", "session_id", "_block").agg(
        F.min("_first").alias("arrival_time"), F.max("_last").alias("departure_time")
    )
    duration = seconds_between(F.col("arrival_time"), F.col("departure_time"))
    return stays.withColumn("duration_seconds", duration).filter(F.col("duration_seconds") > min_stay_seconds)


def port_stays(
    in_port: DataFrame,
    min_stay_seconds: int = MIN_STAY_SECONDS,
    max_gap_seconds: int | None = None,
    slice_seconds: int = SLICE_SECONDS,
    crowded: DataFrame | None = None,
    collapse: bool = True,
) -> DataFrame:
    """Arrival, departure and duration of each session longer than ``min_stay_seconds``.

    Copies of a ping do not change a stay, so they collapse on the map side first; where ``crowded_slices`` found none,
    there is no large group of copies either, and ``collapse=False`` saves that shuffle. The pings of a slice
    then shrink to one row per run before the slices are chained. ``crowded`` are borders from ``crowded_slices``
    of the same pings, or of those they were taken from.
    """
    return stay_blocks(in_port, min_stay_seconds, max_gap_seconds, slice_seconds, crowded, collapse).drop("_block")


def journeys(stays: DataFrame, block: str | None = None, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Consecutive stays of a vessel in differently named ports; ``origin_port`` and ``destination_port`` are appended.

    A vessel's stays are unbounded (one id may stand for thousands of names), so they are windowed inside the slice of
    their arrival, or in ``block``, a column that grows with the order of stays. What a slice's last stay is followed by is
    found among the first and last stays of the vessel's slices alone, two a slice at most.
    """
    helpers = "_(slot|opens|closes|edge|next)"
    plain, name, restored = put_aside(stays.drop("origin_port", "destination_port"), helpers)
    slot = F.col(name(block)) if block else F.coalesce(F.floor(epoch_seconds(F.col("arrival_time")) / slice_seconds), F.lit(_NO_KEY).cast("bigint"))
    order = ("arrival_time", "session_id", "port_id", "vessel_name")
    slotted = plain.withColumn("_slot", slot)
    inside = Window.partitionBy("mmsi", "_slot").orderBy(*order)
    near = slotted.withColumns(
        {
            "_next": F.lead("port_name").over(inside),
            "_opens": F.lag(F.lit(True)).over(inside).isNull(),
            "_closes": F.lead(F.lit(True)).over(inside).isNull(),
        }
    )
    # NULL for edges, which thus meet by vessel; all others stay with their slot
    near = near.withColumn("_edge", F.when(~(F.col("_opens") | F.col("_closes")), F.col("_slot")))
    edges = Window.partitionBy("mmsi", "_edge").orderBy("_slot", *order)
    legs = near.withColumn("_next", F.when(F.col("_closes"), F.lead("port_name").over(edges)).otherwise(F.col("_next")))
    legs = legs.where(F.col("_next").isNotNull() & (F.col("port_name") != F.col("_next")))
    return restored(legs.select(*plain.columns, F.col("port_name").alias("origin_port"), F.col("_next").alias("destination_port")))


def od_counts(legs: DataFrame) -> DataFrame:
    """Journeys per (origin, destination), not sorted."""
    return legs.groupBy("origin_port", "destination_port").agg(F.count(F.lit(1)).alias("count"))


def od_matrix(legs: DataFrame) -> DataFrame:
    """Journeys per (origin, destination), busiest first."""
    return od_counts(legs).orderBy(F.desc("count"), "origin_port", "destination_port")
