"""Joins of places within a distance whose times overlap, over a grid of latitude, longitude and time.

Rows of the grid are as high as the radius, and in each row cells are as wide as the radius is there, so a place needs the
few cells around its own wherever it lies, also across the date line and near the poles. Times are cut in slots;
a pair that shares several is reported in the first. Crowded cells are dealt in lots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfield.operators.joins import haversine_km
from tallyfield.session import stored

EARTH_KM = 6371.0
#: Rows of the left side in one cell from which the cell is dealt in lots of that many.
DENSE = 5_000
#: Rounding is kept on the safe side: cells look a little further than the radius.
SLACK = 1 + 1e-9


class Grid:
    """Cells for a radius in kilometres, as columns."""

    def __init__(self, radius_km: float):
        self.angle = radius_km / EARTH_KM
        self.height = min(self.angle * 57.29577951308232 * SLACK, 180.0)
        self.rows = int(180.0 // self.height) + 1

    def row(self, lat: Column) -> Column:
        return F.floor((lat + 90.0) / self.height).cast("int")

    def cells_in(self, row: Column) -> Column:
        """Cells of a row: as many as fit if each is at least as wide as the radius is at the row's edge nearer to a pole."""
        edge = F.greatest(F.abs(row * self.height - 90.0), F.abs((row + 1) * self.height - 90.0))
        return F.greatest(F.floor(F.cos(F.radians(F.least(edge, F.lit(90.0)))) * (360.0 / self.height)), F.lit(1)).cast("int")

    def column(self, lon: Column, row: Column) -> Column:
        n = self.cells_in(row)
        return F.pmod(F.floor((lon + 180.0) / 360.0 * n), n).cast("int")

    def own(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """With _y and _x: the cell of each place."""
        placed = df.withColumn("_y", self.row(F.col(lat)))
        return placed.withColumn("_x", self.column(F.col(lon), F.col("_y")))

    def around(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """A row for each cell that may hold a place within the radius."""
        own = self.row(F.col(lat))
        rows = df.withColumn("_y", F.explode(F.sequence(F.greatest(own - 1, F.lit(0)), F.least(own + 1, F.lit(self.rows)))))
        # within the radius of a pole every longitude is near
        away = F.abs(F.radians(lat)) + self.angle * SLACK < 1.5707963
        widest = F.asin(F.least(F.sin(F.lit(self.angle)) / F.cos(F.radians(lat)), F.lit(1.0)))
        reach = F.when(away, F.degrees(widest) * SLACK).otherwise(180.0)
        n = self.cells_in(F.col("_y"))
        low, high = (F.floor((F.col(lon) + 180.0 + sign * reach) / 360.0 * n) for sign in (-1, 1))
        return rows.withColumn("_x", F.explode(F.sequence(low, F.least(high, low + n - 1)))).withColumn("_x", F.pmod("_x", n).cast("int"))


def near_and_overlapping(left: DataFrame, right: DataFrame, radius_km: float, left_id: str, right_id: str, keep: Sequence[str] = (),
                         slot_hours: float = 24.0, dense: int = DENSE) -> DataFrame:
    """(left_id, right_id, distance_km, keep...): pairs within the radius whose times overlap, each once.

    Both sides have lat, lon, started and ended; an end that is missing is the start. ``keep`` names columns of the right
    side. Rows without a place on the globe or a start pair with nothing. A side's long intervals fall
    in many slots, so ``slot_hours`` should not be far below the usual length.
    """
    grid, seconds = Grid(radius_km), slot_hours * 3600.0

    def timed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        sound = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180) & F.col("started").isNotNull()
        moment = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
        ready = df.where(sound).select(*columns, "lat", "lon", moment("started").alias("_from"), moment("ended").alias("_to"))
        ready = ready.withColumn("_to", F.coalesce("_to", "_from")).where("_to >= _from")
        slot = lambda c: F.floor(F.col(c) / (seconds * 1e6))
        return ready.withColumn("_first", slot("_from")).withColumn("_slot", F.explode(F.sequence(F.col("_first"), slot("_to"))))

    key = ["_y", "_x", "_slot"]
    a = stored(grid.around(timed(left, [left_id]), "lat", "lon"), "places-left")
    b = grid.own(timed(right, [right_id, *keep]), "lat", "lon")
    crowd = a.groupBy(*key).agg(F.count(F.lit(1)).alias("_held")).where(F.col("_held") > dense).withColumn("_lots", F.ceil(F.col("_held") / dense).cast("int"))
    crowd = stored(crowd.drop("_held"), "places-crowd")
    lots = F.coalesce("_lots", F.lit(1))
    a = a.join(crowd, key, "left").withColumn("_lot", F.pmod(F.xxhash64(left_id), lots).cast("int")).drop("_lots")
    b = b.join(crowd, key, "left").withColumn("_lot", F.explode(F.sequence(F.lit(0), lots - 1))).drop("_lots")
    b = b.select(*key, "_lot", right_id, *keep, *[F.col(c).alias(f"{c}_b") for c in ("lat", "lon", "_from", "_to", "_first")])
    distance = haversine_km(F.col("lat"), F.col("lon"), F.col("lat_b"), F.col("lon_b"))
    return (
        a.join(b, [*key, "_lot"])
        .where("_from <= _to_b and _from_b <= _to and _slot = greatest(_first, _first_b)")
        .withColumn("distance_km", distance)
        .where(F.col("distance_km") <= radius_km)
        .select(left_id, right_id, "distance_km", *keep)
    )


def affected_routes(incidents: DataFrame, routes: DataFrame, radius_km: float, slot_hours: float = 24.0) -> DataFrame:
    """One diversion record per (incident, route) near each other in place and time, nearest route first.

    An incident without one gives one record of type ``no_route``. ``routes`` has route_id and alternative_routes.
    """
    near = near_and_overlapping(incidents, routes, radius_km, "incident_id", "route_id", ["alternative_routes"], slot_hours)
    return incidents.select("incident_id", "estimated_duration").join(near, "incident_id", "left").select(
        F.when(F.col("route_id").isNull(), "no_route").otherwise("route_diversion").alias("type"),
        "incident_id",
        F.col("route_id").alias("affected_route"),
        "alternative_routes",
        F.col("estimated_duration").alias("estimated_delay"),
        "distance_km",
    )
