"""Inflow and outflow of sectors around incidents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowtide.functions.calendar import as_day
from flowtide.plans.skew import expand_copies, skewed_join
from flowtide.session import ensure_checkpoints

# fixed values: sectors left out, the renamed sector, and the unit of the flow axis
LEFT_OUT = ("Privacy & Security", "Unknown")
RENAMED_SECTOR = ("Asset Management", "Liquid Staking & Asset Management")
FLOW_UNIT = 1e10

RATIO_COLUMNS = ("time", "type", "inflow", "outflow")


def typed_edges(edges: DataFrame, nodes: DataFrame, match_time: bool = False, folded: bool = True) -> DataFrame:
    """Attach the sector of both ends.

    By default nodes are matched on their id alone, so an edge repeats for every time slice its ends
    occur in. The repeats are carried as ``copies``, and written out as rows where ``folded=False``.
    ``match_time=True`` matches within the edge's slice.
    """
    on_time = ["time"] if match_time else []
    kept = nodes.where(F.col("type").isNull() | ~F.col("type").isin(*LEFT_OUT))
    types = kept.groupBy(*on_time, "id", "type").agg(F.count("*").alias("_n"))

    def attach(df: DataFrame, end: str, other: str) -> DataFrame:
        side = types.withColumnsRenamed({"id": end, "type": f"{end}_type", "_n": f"_{end}_n"})
        return skewed_join(df, side, [*on_time, end])

    both = attach(attach(edges.select("time", "source", "target", "size"), "source", "target"), "target", "source")
    one = F.lit(1).cast("bigint")
    typed = both.select(
        "time",
        "source",
        "target",
        "size",
        "source_type",
        "target_type",
        (F.coalesce("_source_n", one) * F.coalesce("_target_n", one)).alias("copies"),
    )
    return typed if folded else expand_copies(typed)


def sector_flows(typed: DataFrame) -> DataFrame:
    """Inflow per (target sector, time) and negated outflow per (source sector, time), stacked.

    Each side is filled up with 0 to its own full sector × time grid: ``time, type, inflow, outflow``, one of the
    two NULL. ``typed`` may be folded.
    """
    size = F.col("size") * F.col("copies") if "copies" in typed.columns else F.col("size")
    sides = F.array(
        F.struct(F.lit("in").alias("side"), F.col("target_type").alias("type"), size.alias("flow")),
        F.struct(F.lit("out").alias("side"), F.col("source_type").alias("type"), (-size).alias("flow")),
    )
    totals = (
        typed.select("time", F.explode(sides).alias("s"))
        .select("time", "s.side", "s.type", "s.flow")
        .dropna(subset=["time", "type"])
        .groupBy("side", "time", "type")
        .agg(F.sum("flow").alias("flow"))
    )
    # written once: the grid below reads it three times
    ensure_checkpoints(typed.sparkSession)
    totals = totals.checkpoint()
    times, types = (totals.select("side", c).distinct() for c in ("time", "type"))
    grid = times.join(types, "side").join(totals, ["side", "time", "type"], "left")
    flow = F.coalesce("flow", F.lit(0.0)) + F.lit(0.0)
    return grid.select(
        "time",
        "type",
        F.when(F.col("side") == "in", flow).alias("inflow"),
        F.when(F.col("side") == "out", flow).alias("outflow"),
    )


def _known(name: str) -> Column:
    return F.when(~F.isnan(name), F.col(name))


def flow_ratio(df: DataFrame, order_by: str = "inflow") -> DataFrame:
    """Add ``ratio`` = |first / second| of the two known values of a (time, type) group of two rows.

    Inflows come before outflows; the ratio stands on the rows with an inflow. Of two inflows the smaller
    ``order_by`` is the first. Any other group, and a second value of 0, gives NULL.
    """
    missing = [c for c in RATIO_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}; needed: {', '.join(RATIO_COLUMNS)}")
    rows = df.withColumns({"inflow": _known("inflow"), "outflow": _known("outflow")})
    known_order = F.when(F.col("inflow").isNotNull(), F.col(order_by))
    groups = rows.groupBy("time", "type").agg(
        F.count("*").alias("rows"),
        F.count("inflow").alias("inflows"),
        F.count("outflow").alias("outflows"),
        F.min_by("inflow", known_order).alias("first_in"),
        F.max_by("inflow", known_order).alias("last_in"),
        F.max("outflow").alias("any_out"),
    )
    second = F.when(F.col("inflows") == 2, F.col("last_in")).otherwise(F.col("any_out"))
    two_values = (F.col("rows") == 2) & (F.col("inflows") + F.col("outflows") == 2) & (F.col("inflows") > 0)
    ratios = groups.where(two_values & (second != 0)).select(
        "time", "type", F.abs(F.col("first_in") / second).alias("_ratio")
    )
    ratio = F.when(F.col("inflow").isNotNull(), F.col("_ratio")).alias("ratio")
    joined = skewed_join(rows, ratios, ["time", "type"])
    return joined.select(*df.columns, ratio)


def incident_frame(flows: DataFrame, incident: str | date, unit: float = FLOW_UNIT) -> DataFrame:
    """Final frame: net flow in ``unit``, date text, display sector and whether the row is the incident's day."""
    old, new = RENAMED_SECTOR
    zero = F.lit(0.0)
    flow = (F.coalesce("inflow", zero) + F.coalesce("outflow", zero)) / unit
    return flows.select(
        F.date_format("time", "yyyy-MM-dd").alias("time"),
        "type",
        "inflow",
        "outflow",
        "ratio",
        flow.alias("flow"),
        F.when(F.col("type") == old, new).otherwise(F.col("type")).alias("sector"),
        (F.to_date("time") == F.lit(as_day(incident))).alias("is_incident"),
    )
