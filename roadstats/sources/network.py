"""The road network dimension: 14 nodes with grid coordinates, 13 directed links.

Both tables are tiny and fixed (a proven size bound), so joins against them broadcast.
A link is named start node + end node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# --- Fixed values: network geometry --------------------------------------------------------------
# Node -> (x, y) on the abstract grid.
NODES: dict[str, tuple[float, float]] = {
    "I1": (1.0, 0.0),
    "I2": (2.0, 0.0),
    "I3": (3.0, 0.0),
    "I4": (4.0, 0.0),
    "W1": (0.0, 0.0),
    "E1": (5.0, 0.0),
    "N1": (1.0, 1.0),
    "N2": (2.0, 1.0),
    "N3": (3.0, 1.0),
    "N4": (4.0, 1.0),
    "S1": (1.0, -1.0),
    "S2": (2.0, -1.0),
    "S3": (3.0, -1.0),
    "S4": (4.0, -1.0),
}
# Link -> (start node, end node), in declaration order.
LINKS: dict[str, tuple[str, str]] = {
    "I1W1": ("I1", "W1"),
    "I2I1": ("I2", "I1"),
    "I3I2": ("I3", "I2"),
    "I4I3": ("I4", "I3"),
    "E1I4": ("E1", "I4"),
    "N1I1": ("N1", "I1"),
    "I1S1": ("I1", "S1"),
    "N3I3": ("N3", "I3"),
    "I3S3": ("I3", "S3"),
    "S2I2": ("S2", "I2"),
    "I2N2": ("I2", "N2"),
    "S4I4": ("S4", "I4"),
    "I4N4": ("I4", "N4"),
}
# ---------------------------------------------------------------------------------------------------

LINK_ORDER: tuple[str, ...] = tuple(LINKS)


def _values(rows: list[tuple]) -> str:
    def lit(v) -> str:
        return f"'{v}'" if isinstance(v, str) else repr(v)

    return ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)


def nodes_df(spark: SparkSession) -> DataFrame:
    """``node STRING, x DOUBLE, y DOUBLE`` as an inline table (a local relation: no scan tasks)."""
    rows = [(name, x, y) for name, (x, y) in NODES.items()]
    return spark.sql(
        f"SELECT CAST(node AS STRING) AS node, CAST(x AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y "
        f"FROM VALUES {_values(rows)} AS nodes(node, x, y)"
    )


def links_df(spark: SparkSession) -> DataFrame:
    """``link STRING, start STRING, end STRING, seq INT`` (``seq`` = declaration order), inline."""
    rows = [(name, a, b, i) for i, (name, (a, b)) in enumerate(LINKS.items())]
    return spark.sql(
        "SELECT CAST(link AS STRING) AS link, CAST(start AS STRING) AS start, CAST(`end` AS STRING) AS `end`, "
        f"CAST(seq AS INT) AS seq FROM VALUES {_values(rows)} AS links(link, start, `end`, seq)"
    )
