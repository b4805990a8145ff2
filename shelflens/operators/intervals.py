"""Values and points found in the intervals and areas that hold them, by cells of a size that fits each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import in_polygon
from .prefix import running, saved

STEP = 3  #: sizes are powers of 2 ** STEP
_FAR = float(1 << 52)


def _level(size: Column, reach: Column) -> Column:
    """The exponent of the cell for something of this size, no less than what keeps cell numbers whole at this distance from 0."""
    fit = lambda x: F.ceil(F.log2(x) / STEP) * STEP
    least = F.when(reach > 0, fit(reach) - 48).otherwise(F.lit(-1020))
    return F.greatest(F.when(size > 0, fit(size) - STEP).otherwise(least), least, F.lit(-1020)).cast("int")


def _cell(x: Column, level: Column) -> Column:
    """The number of the cell that a value lies in; null for one too far off to lie in any cell of that size."""
    q = x / F.pow(F.lit(2.0), level)
    return F.when(F.abs(q) < _FAR, F.floor(q))


def interval_join(rows: DataFrame, bands: DataFrame, keys: list[str], value: str, low: str = "low", high: str = "high") -> DataFrame:
    """Each row with the bands of its keys that hold its value, the upper end left out.

    A band is laid out over the 2 to 10 cells of its own size class that it covers; sizes of a class differ up to
    2 ** STEP times. A row looks up its cell of every class that there is. So a row meets bands of its neighbourhood
    only, long ones by their long cells, however many bands a key has. Bands without an end meet the rows of their
    keys. Empty bands, and nulls at either side, meet nothing.
    """
    ends = bands.where(F.col(low) < F.col(high)).withColumn("_a", F.col(low).cast("double")).withColumn("_b", F.col(high).cast("double"))
    finite = (F.abs("_a") < float("inf")) & (F.abs("_b") < float("inf"))
    laid = ends.where(finite).withColumn("_level", _level(F.col("_b") - F.col("_a"), F.greatest(F.abs("_a"), F.abs("_b"))))
    laid = laid.withColumn("_cell", F.explode(F.sequence(_cell(F.col("_a"), F.col("_level")), _cell(F.col("_b"), F.col("_level")))))
    classes = sorted(r[0] for r in laid.select("_level").distinct().collect())  # some 700 at most, a handful as a rule
    inside = (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))
    names = [*rows.columns, *[c for c in bands.columns if c not in keys]]
    open_ = rows.join(ends.where(~finite), keys).where(inside).select(*names)
    if not classes:
        return open_
    asked = rows.withColumn("_level", F.explode(F.array(*map(F.lit, classes))))
    asked = asked.withColumn("_cell", _cell(F.col(value).cast("double"), F.col("_level")))
    return asked.join(laid, [*keys, "_level", "_cell"]).where(inside).select(*names).unionByName(open_)


def interval_sums(rows: DataFrame, bands: DataFrame, keys: list[str], value: str, sums: str, low: str = "low", high: str = "high") -> DataFrame:
    """The bands that hold a row of their keys, and the sum of the column `sums` over the rows that interval_join finds for each; no pair is made.

    Values and ends are put in one order, where a band's sum is what lies before its upper end less what lies before its
    lower end. So the work grows with rows and bands, however many bands hold a row. Equal values and equal ends count
    once. Rows outside of all bands of their keys are left out first. Nulls of `sums` count as 0. Sums of doubles may
    differ in the last places.
    """
    whole = bands.where(F.col(low) < F.col(high))
    reach = whole.groupBy(*keys).agg(F.min(low).alias("_least"), F.max(high).alias("_most"))
    inside = rows.join(reach, keys).where((F.col(value) >= F.col("_least")) & (F.col(value) < F.col("_most")))
    values = inside.groupBy(*keys, F.col(value).alias("_at")).agg(F.sum(sums).alias("_sum"), F.count("*").alias("_rows")).withColumn("_is_row", F.lit(True))
    ends = whole.select(*keys, F.explode(F.array(F.col(low), F.col(high))).alias("_at")).distinct().withColumn("_is_row", F.lit(False))
    # an end comes before the values equal to it
    found = running(values.unionByName(ends, allowMissingColumns=True), keys, [F.col("_at"), F.col("_is_row")], ["_sum", "_rows"]).where("not _is_row")
    found = saved(found.select(*keys, "_at", F.col("_before__sum").alias("_sum"), F.col("_before__rows").alias("_rows")), "interval-ends")
    at = lambda end, name: found.select(*keys, F.col("_at").alias(end), F.col("_sum").alias(f"_sum_{name}"), F.col("_rows").alias(f"_rows_{name}"))
    told = whole.join(at(low, "low"), [*keys, low]).join(at(high, "high"), [*keys, high]).where("_rows_high > _rows_low")
    return told.select(*bands.columns, (F.col("_sum_high") - F.col("_sum_low")).alias(sums))


def _crosses(ring: Column, x0: Column, y0: Column, side: Column) -> Column:
    """Whether an edge of the ring may touch the square: their boxes meet and the square's corners aren't all on one side of it."""
    n = F.size(ring)
    edges = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, (i + 1) % n).alias("b")))
    turn = lambda e, x, y: (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])
    x1, y1 = x0 + side, y0 + side

    def meets(e: Column) -> Column:
        turns = [turn(e, x, y) for x in (x0, x1) for y in (y0, y1)]
        apart = (F.greatest(e["a"]["x"], e["b"]["x"]) < x0) | (F.least(e["a"]["x"], e["b"]["x"]) > x1) | (F.greatest(e["a"]["y"], e["b"]["y"]) < y0) | (F.least(e["a"]["y"], e["b"]["y"]) > y1)
        slack = 1e-6 * side * (F.abs(e["b"]["x"] - e["a"]["x"]) + F.abs(e["b"]["y"] - e["a"]["y"]))  # for rounding: a near miss is tested exactly
        return ~apart & (F.least(*turns) <= slack) & (F.greatest(*turns) >= -slack)

    return F.exists(edges, meets)


def polygon_cells(polygons: DataFrame, across: int = 4) -> DataFrame:
    """zone, ring, _level, _cx, _cy, _whole: the cells that a polygon (zone, ring) touches, and whether it covers them.

    The cells' size is a class of powers of two that fits the polygon, about `across` to 8 * `across` cells along its
    longer side, in whatever unit the map has. A cell that no edge touches lies wholly inside or outside.
    """
    xs, ys = F.transform("ring", lambda p: p["x"].cast("double")), F.transform("ring", lambda p: p["y"].cast("double"))
    box = polygons.where(F.size("ring") > 0).select("zone", "ring", F.array_min(xs).alias("_x0"), F.array_max(xs).alias("_x1"), F.array_min(ys).alias("_y0"), F.array_max(ys).alias("_y1"))
    size, reach = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0")), F.greatest(*[F.abs(c) for c in ("_x0", "_x1", "_y0", "_y1")])
    rows = box.withColumn("_level", _level(size / across, reach))
    for c in ("x", "y"):
        rows = rows.withColumn(f"_c{c}", F.explode(F.sequence(_cell(F.col(f"_{c}0"), F.col("_level")), _cell(F.col(f"_{c}1"), F.col("_level")))))
    side = F.pow(F.lit(2.0), F.col("_level"))
    x, y = F.col("_cx") * side, F.col("_cy") * side
    rows = rows.withColumn("_edge", _crosses(F.col("ring"), x, y, side)).withColumn("_in", in_polygon(x + side / 2, y + side / 2, F.col("ring")))
    return rows.where("_edge or _in").select("zone", F.when(F.col("_edge"), F.col("ring")).alias("ring"), "_level", "_cx", "_cy", (~F.col("_edge")).alias("_whole"))


def points_in_areas(points: DataFrame, polygons: DataFrame, across: int = 4) -> DataFrame:
    """id, zone of every point (id, x, y) in or on the edge of a polygon (zone, ring of (x, y)).

    A point looks up its cell of every size there is. Cells wholly inside a polygon answer without the exact test and
    carry no ring.
    """
    cells = polygon_cells(polygons, across)
    classes = sorted(r[0] for r in cells.select("_level").distinct().collect())
    if not classes:
        return points.join(polygons.select("zone"), F.lit(False)).select("id", "zone")
    asked = points.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.explode(F.array(*map(F.lit, classes))).alias("_level"))
    asked = asked.withColumn("_cx", _cell(F.col("x"), F.col("_level"))).withColumn("_cy", _cell(F.col("y"), F.col("_level")))
    found = asked.join(cells, ["_level", "_cx", "_cy"])
    return found.where(F.col("_whole") | in_polygon(F.col("x"), F.col("y"), F.col("ring"))).select("id", "zone")
