"""Tiles, distances and points."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: latitude at which the square Mercator map ends.
EDGE = 85.05112878


def tile_xy(lng: Column, lat: Column, zoom: int = 10) -> tuple[Column, Column]:
    size = 1 << zoom
    phi = F.radians(F.least(F.greatest(lat, F.lit(-EDGE)), F.lit(EDGE)))
    clamp = lambda x: F.floor(F.least(F.greatest(x, F.lit(0.0)), F.lit(size - 1.0))).cast("long")
    return clamp((lng + 180) / 360 * size), clamp((1 - F.ln(F.tan(phi) + 1 / F.cos(phi)) / F.pi()) / 2 * size)


def tile_id(lng: Column, lat: Column, zoom: int = 10) -> Column:
    """x * 2 ** zoom + y of the Web Mercator tile."""
    x, y = tile_xy(lng, lat, zoom)
    return x * (1 << zoom) + y


def haversine_km(lng1: Column, lat1: Column, lng2: Column, lat2: Column) -> Column:
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), F.lit(2.0))
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lng1, lng2)
    return 2 * 6371.0088 * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def floor_bin(value: Column, width: int = 100) -> Column:
    """Lower edge of the bin; negative values go down."""
    return (F.floor(value / width) * width).cast("long")


def usable_points(df, lng: str = "lng", lat: str = "lat", issue: str | None = "spatial_issue"):
    """Points with coordinates, rounded to 3 places, without (0, 0), (1, 1) and flagged ones."""
    out = df.withColumns({lng: F.round(lng, 3), lat: F.round(lat, 3)}).where(f"{lng} IS NOT NULL AND {lat} IS NOT NULL AND NOT ({lng} = 0 AND {lat} = 0) AND NOT ({lng} = 1 AND {lat} = 1)")
    return out.where(~F.coalesce(F.col(issue), F.lit(False))) if issue and issue in df.columns else out


def wkb_points(df, column: str = "wkb"):
    """Adds lng and lat of little-endian WKB points."""

    @F.pandas_udf("lng double, lat double")
    def read(points: pd.Series) -> pd.DataFrame:
        whole = points.map(len, na_action="ignore").fillna(0).to_numpy() >= 21
        out = np.full((len(points), 2), np.nan)
        # one byte order mark, four bytes of type, two doubles
        out[whole] = np.frombuffer(b"".join(b[5:21] for b in points[whole]), "<f8").reshape(-1, 2)
        return pd.DataFrame(out, columns=["lng", "lat"])

    # a value that is no point is null
    point = F.col("_p")
    return df.withColumn("_p", read(column)).withColumns({c: F.when(~F.isnan(point.getField(c)), F.round(point.getField(c), 3)) for c in ("lng", "lat")}).drop("_p")
