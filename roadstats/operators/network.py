"""Network dimension operators: segments, integrity checks, and the map state at a time.

The network tables are a fixed 14/13 rows built from constants, so joins against them carry
an explicit broadcast hint (a proven size bound). A caller-supplied network gets no hint:
Catalyst statistics and AQE choose broadcast below ``autoBroadcastJoinThreshold`` and a
shuffle join above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstats.functions.columns import line_width, speed_color, speed_ratio
from roadstats.operators.queries import latest_per_link, link_state_at
from roadstats.schemas import FREE_FLOW_SPEED, MAP_STATE_TOLERANCE
from roadstats.sources.network import links_df, nodes_df


def _maybe_broadcast(df: DataFrame, proven_small: bool) -> DataFrame:
    return F.broadcast(df) if proven_small else df


def link_segments(
    spark: SparkSession,
    nodes: DataFrame | None = None,
    links: DataFrame | None = None,
    observed: DataFrame | None = None,
) -> DataFrame:
    """``link, start, end, x0, y0, x1, y1``: one drawable segment per link (inner joins).

    With ``observed`` (any table with a ``link`` column, e.g. ``stats``), only the segments of
    links that appear in the data: the distinct observed links are streamed and the segments
    (the bounded side) are the build side of the join.
    """
    builtin = nodes is None and links is None
    if observed is not None:
        segs = link_segments(spark, nodes, links)
        seen = observed.select("link").where(F.col("link").isNotNull()).distinct()
        return seen.join(_maybe_broadcast(segs, builtin), "link", "inner").select(*segs.columns)
    nodes = nodes if nodes is not None else nodes_df(spark)
    links = links if links is not None else links_df(spark)
    start = _maybe_broadcast(nodes.select(F.col("node").alias("start"), F.col("x").alias("x0"), F.col("y").alias("y0")), builtin)
    end = _maybe_broadcast(nodes.select(F.col("node").alias("end"), F.col("x").alias("x1"), F.col("y").alias("y1")), builtin)
    cols = ["link", "start", "end", "x0", "y0", "x1", "y1"] + (["seq"] if "seq" in links.columns else [])
    return links.join(start, "start", "inner").join(end, "end", "inner").select(*cols)


CHECKS: tuple[str, ...] = (
    "unknown_endpoint",
    "orphan_node",
    "segment_count",
    "non_finite_coordinate",
    "duplicate_link",
    "duplicate_coordinate",
)


def network_checks(
    spark: SparkSession,
    observed: DataFrame | None = None,
    nodes: DataFrame | None = None,
    links: DataFrame | None = None,
) -> DataFrame:
    """Integrity report ``check, violations, ok``, one row per check.

    Structural checks: an unknown link endpoint, a node on no link, segment count != link
    count, a non-finite segment coordinate, a repeated link name, two nodes on one coordinate.
    With ``observed`` (any table with a ``link`` column, e.g. ``stats``) there is one more check,
    ``unmapped_link``: road links seen in the data that the network lacks. Those rows get no
    segment. All checks are answered from one tagged union: one ``groupBy`` on (kind, name, x, y),
    then one global aggregate that is unpivoted into report rows. That is one shuffle instead of
    one per check.
    """
    builtin = nodes is None and links is None
    nodes = nodes if nodes is not None else nodes_df(spark)
    links = links if links is not None else links_df(spark)
    segments = link_segments(spark, nodes, links)
    null_d, zero, one = F.lit(None).cast("double"), F.lit(0), F.lit(1)

    def fact(df: DataFrame, kind: str, name, x=null_d, y=null_d, is_node=zero, is_end=zero, bad=zero) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"),
            name.cast("string").alias("name"),
            x.alias("x"),
            y.alias("y"),
            is_node.alias("is_node"),
            is_end.alias("is_end"),
            bad.alias("bad"),
        )

    finite = F.lit(True)
    for c in ("x0", "y0", "x1", "y1"):
        finite = finite & F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) != F.lit(float("inf")))
    facts = [
        fact(nodes, "name", F.col("node"), is_node=one),
        fact(links, "name", F.col("start"), is_end=one),
        fact(links, "name", F.col("end"), is_end=one),
        fact(links, "link", F.col("link")),
        fact(nodes, "coord", F.lit(None), F.col("x"), F.col("y")),
        fact(segments, "segment", F.col("link"), bad=F.when(finite, 0).otherwise(1)),
    ]
    if observed is not None:
        seen = observed.select("link").where(F.col("link").isNotNull()).distinct()
        unmapped = seen.join(_maybe_broadcast(links.select("link"), builtin), "link", "left_anti")
        facts.append(fact(unmapped, "unmapped", F.col("link")))
    union = facts[0]
    for f in facts[1:]:
        union = union.unionByName(f)
    grouped = union.groupBy("kind", "name", "x", "y").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_node").alias("nodes"), F.sum("is_end").alias("ends"), F.sum("bad").alias("bad")
    )
    kind = F.col("kind")
    counts = {
        "unknown_endpoint": F.sum(F.when((kind == "name") & (F.col("nodes") == 0), F.col("ends")).otherwise(0)),
        "orphan_node": F.sum(F.when((kind == "name") & (F.col("ends") == 0), F.col("nodes")).otherwise(0)),
        "segment_count": F.when(
            F.sum(F.when(kind == "link", F.col("n")).otherwise(0)) != F.sum(F.when(kind == "segment", F.col("n")).otherwise(0)), 1
        ).otherwise(0),
        "non_finite_coordinate": F.sum(F.when(kind == "segment", F.col("bad")).otherwise(0)),
        "duplicate_link": F.sum(F.when((kind == "link") & (F.col("n") > 1), 1).otherwise(0)),
        "duplicate_coordinate": F.sum(F.when((kind == "coord") & (F.col("n") > 1), 1).otherwise(0)),
    }
    names = list(CHECKS) + (["unmapped_link"] if observed is not None else [])
    if observed is not None:
        counts["unmapped_link"] = F.sum(F.when(kind == "unmapped", F.col("n")).otherwise(0))
    totals = grouped.agg(*[F.coalesce(counts[c], F.lit(0)).cast("long").alias(c) for c in names])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("violations")) for c in names]))
    return totals.select(rows.alias("r")).select("r.check", "r.violations", (F.col("r.violations") == 0).alias("ok"))


def network_state_at(
    spark: SparkSession,
    stats: DataFrame,
    t: float | None = None,
    tolerance: float = MAP_STATE_TOLERANCE,
    free_flow: float = FREE_FLOW_SPEED,
    segments: DataFrame | None = None,
) -> DataFrame:
    """Every network link with its state at ``t`` and the map encoding.

    ``link, start, end, x0, y0, x1, y1, has_data, vcount, vspeed, t, ratio, color, width``.
    ``t=None`` means the latest step (a scalar subquery; NaN times are left out). The state is ``link_state_at`` with
    the map's tolerance; links without state keep ``has_data = false`` (grey, width 2); state
    for links the network lacks is dropped. ``vmax`` (peak ``vcount`` over the whole state,
    unknown links included) is a scalar subquery, so there is no join to compute it.
    """
    if tolerance < 0:
        raise ValueError(f"tolerance must be non-negative, got {tolerance}")
    segs = segments if segments is not None else link_segments(spark)
    if t is None:
        # Nothing but NaN lies above the latest step, so one bound is enough; with the
        # subtraction inside the subquery it reaches the scan as a pushed filter.
        number = F.when(~F.isnan("t"), F.col("t"))
        lo = stats.agg((F.max(number) - F.lit(float(tolerance))).alias("lo")).scalar()
        state = latest_per_link(stats.where((F.col("t") >= lo) & ~F.isnan("t")))
    else:
        state = link_state_at(stats, t, tolerance)
    # The peak is read from the same aggregate (all its columns), whose exchange is reused.
    peak = state.agg(F.max(F.struct("vcount", "vspeed", "t")).alias("peak"))
    vmax = peak.select(F.col("peak.vcount").alias("vmax")).scalar()
    # Every segment is kept, so the segments are the streamed (preserved) side and the state
    # the build side. State has one row per observed link but no static bound, so no hint:
    # AQE sees its runtime size after the aggregate and broadcasts it when it is small,
    # otherwise the join stays a shuffle join.
    joined = segs.join(state, "link", "left")
    has_data = F.col("t").isNotNull()
    ratio = speed_ratio(F.col("vspeed"), free_flow)
    return joined.select(
        *segs.columns,
        has_data.alias("has_data"),
        "vcount",
        "vspeed",
        "t",
        F.when(has_data, ratio).alias("ratio"),
        speed_color(ratio, has_data).alias("color"),
        line_width(F.col("vcount"), F.coalesce(vmax, F.lit(0)), has_data).alias("width"),
    )
