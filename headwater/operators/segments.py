"""Stream segments (DGOs) with all that is known of them, by location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.operators.joins import drop_repeated, rme_wide
from headwater.operators.ranking import first_per_key
from headwater.operators.vector import as_wkt, dissolve, layer_measures

PLACE = ("level_path", "seg_distance")


def rme_wide_dissolved(dgos: DataFrame, sides: Sequence[DataFrame], igos: DataFrame, constants: dict[str, Column] | None = None, geom: str = "geom", key: str = "dgoid") -> DataFrame:
    """One row per location whose segments unite to one polygon: ``constants``, the attributes of the segment with the smallest
    ``key``, longitude and latitude of the location's point, that segment's side tables, and the union as WKT, ``dgo_geom``.

    ``igos`` hold a point (WKB, ``geom``) per location; a location with several has a row for each, as in a plain join. Locations
    without point or whose segment lacks a side table are left out, like those of several parts and those whose
    segments overlap. NULL places match nothing.
    """
    place = list(PLACE)
    known = dgos.filter(F.col(place[0]).isNotNull() & F.col(place[1]).isNotNull())
    union = dissolve(known, place, single_part=True, geom=geom).filter("NOT overlap").select(*place, as_wkt(F.col(geom)).alias("dgo_geom"))
    first = first_per_key(known.drop(geom), place, key)
    points = layer_measures(igos.select(*place, geom), geom).select(*place, F.col("centroid_x").alias("longitude"), F.col("centroid_y").alias("latitude"))
    segments = first.join(points, place)
    wide = rme_wide(segments, [drop_repeated(segments.drop(key), s) for s in sides], key).join(union, place)
    return wide.withColumns(constants) if constants else wide
