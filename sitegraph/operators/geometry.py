"""Spatial joins: points in polygons, by grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import in_ring


def points_in_polygons(points: DataFrame, polygons: DataFrame, keep: str, cell: float) -> DataFrame:
    """points (id, x, y) with the polygon (ring and other columns) that holds each, or nulls.

    Polygons are laid out over the cells of their extent and meet points by an equi-join on the
    cell; of several that hold a point the one with the least value of the column keep stays.
    """
    at = lambda c: F.floor(c / cell)
    xs, ys = F.transform("ring", lambda p: p["x"]), F.transform("ring", lambda p: p["y"])
    laid = (
        polygons.withColumn("cx", F.explode(F.sequence(at(F.array_min(xs)), at(F.array_max(xs)))))
        .withColumn("cy", F.explode(F.sequence(at(F.array_min(ys)), at(F.array_max(ys)))))
    )
    own = [c for c in polygons.columns if c != "ring"]
    hits = (
        points.select("id", "x", "y", at(F.col("x")).alias("cx"), at(F.col("y")).alias("cy"))
        .join(laid, ["cx", "cy"])
        .where(in_ring(F.col("x"), F.col("y"), F.col("ring")))
        .groupBy("id")
        .agg(F.min_by(F.struct(*own), F.struct(keep, *[c for c in own if c != keep])).alias("hit"))
    )
    return points.join(hits, "id", "left").select(*points.columns, *[F.col(f"hit.{c}").alias(c) for c in own])
