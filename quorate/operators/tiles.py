"""Tile histograms, their rollup and the statistics made from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quorate.functions.geo import floor_bin, tile_id
from quorate.session import cut

#: Ranks whose parents take every point, not histograms.
LOW_RANKS = ("FORM", "VARIETY", "SUBSPECIES", "SPECIES")


def seed_tiles(points: DataFrame, entity: str, lng: str = "lng", lat: str = "lat", zoom: int = 10) -> DataFrame:
    """(entity, tile, lng, lat, n): middle of the bounding box and number of points.

    Equal points are counted together before tile ids are computed.
    """
    places = points.groupBy(entity, lng, lat).agg(F.count("*").alias("n"))
    placed = places.withColumn("tile", tile_id(F.col(lng), F.col(lat), zoom))
    middle = lambda c: ((F.min(c) + F.max(c)) / 2).alias(c)
    return placed.groupBy(entity, "tile").agg(middle(lng), middle(lat), F.sum("n").alias("n"))


def guarded_rollup(seeds: DataFrame, edges: DataFrame, entity: str, child: str, parent: str, heavy: int = 50_000, merge: bool = False, levels: int = 20) -> DataFrame:
    """Seeds and, level by level, what parents get from their children's tiles.

    Tiles with over `heavy` points keep a key of their own on every level;
    lighter ones are summed, with the centre of the densest child. Levels are
    not merged with each other unless asked for. Fails where paths are longer
    than `levels`, as in a cycle.
    """
    e = edges.where(F.col(child).isNotNull() & F.col(parent).isNotNull() & (F.col(child) != F.col(parent))).select(F.col(child).alias(entity), F.col(parent).alias("_up")).distinct()
    key = F.when(F.col("n") > heavy, F.concat(F.lit("u:"), F.col("tile").cast("string"), F.lit("#"), F.col(entity).cast("string"))).otherwise(F.concat(F.lit("m:"), F.col("tile").cast("string")))
    front = cut(seeds.select(entity, "tile", "lng", "lat", "n").withColumn("key", key))
    out = front
    for _ in range(levels):
        step = front.join(e, entity).select(F.col("_up").alias("up"), entity, "tile", "lng", "lat", "n", "key")
        summed = step.groupBy("up", "tile", "key").agg(F.max(F.struct("n", (-F.col("lng")).alias("x"), (-F.col("lat")).alias("y"))).alias("c"), F.sum("n").alias("n"))
        again = F.when((F.col("n") > heavy) & F.startswith("key", F.lit("m:")), F.concat(F.lit("u:"), F.col("tile").cast("string"), F.lit("#"), F.col("up").cast("string"))).otherwise(F.col("key"))
        front = cut(summed.select(F.col("up").alias(entity), "tile", (-F.col("c.x")).alias("lng"), (-F.col("c.y")).alias("lat"), "n", again.alias("key")))
        if front.isEmpty():
            break
        out = out.unionByName(front)
    else:
        if not front.join(e, entity).isEmpty():
            raise RuntimeError(f"paths are longer than {levels} steps, or a cycle; raise levels")
    out = out.select(entity, "tile", "lng", "lat", "n")
    if not merge:
        return out
    return out.groupBy(entity, "tile").agg(F.max(F.struct("n", (-F.col("lng")).alias("x"), (-F.col("lat")).alias("y"))).alias("c"), F.sum("n").alias("n")).select(entity, "tile", (-F.col("c.x")).alias("lng"), (-F.col("c.y")).alias("lat"), "n")


def coarsen(tiles: DataFrame, entity: str, most: int = 25_000, heavy: int = 50_000, zoom: int = 10, rounds: int = 8) -> DataFrame:
    """Halves the tile coordinates of light tiles of entities with over `most` tiles, round by round.

    Centres become means weighted by points. Ends after `rounds` or when no entity is over.
    """
    size = 1 << zoom
    for _ in range(rounds):
        wide = tiles.groupBy(entity).agg(F.count("*").alias("_tiles"), F.sum(F.when(F.col("n") < heavy, 1).otherwise(0)).alias("_light")).where((F.col("_tiles") > most) & (F.col("_light") > 0))
        if wide.isEmpty():
            break
        marked = tiles.join(wide.select(entity, F.lit(True).alias("_wide")), entity, "left")
        light = F.coalesce("_wide", F.lit(False)) & (F.col("n") < heavy)
        x, y = F.floor(F.col("tile") / size).cast("long"), F.pmod("tile", F.lit(size))
        half = marked.where(light).withColumn("tile", F.floor(x / 2).cast("long") * size + F.floor(y / 2).cast("long"))
        mean = lambda c: (F.sum(F.col(c) * F.col("n")) / F.sum("n")).alias(c)
        merged = half.groupBy(entity, "tile").agg(mean("lng"), mean("lat"), F.sum("n").alias("n"))
        tiles = cut(marked.where(~light).select(entity, "tile", "lng", "lat", "n").unionByName(merged))
    return tiles


def histogram(df: DataFrame, entity: str, value: str, width: int = 100) -> DataFrame:
    """(entity, bin, n); null values are a bin of their own."""
    return df.groupBy(entity, floor_bin(F.col(value), width).alias("bin")).agg(F.count("*").alias("n"))


def weighted_median(bins: DataFrame, entity: str, value: str = "bin", weight: str = "n") -> DataFrame:
    """The first bin whose running sum reaches half of the total (plus one, halved); null bins are left out."""
    own = bins.where(F.col(value).isNotNull())
    w = Window.partitionBy(entity)
    cum = own.withColumn("_cum", F.sum(weight).over(w.orderBy(value))).withColumn("_all", F.sum(weight).over(w))
    return cum.where(F.col("_cum") * 2 >= F.col("_all") + 1).groupBy(entity).agg(F.min(value).alias("median"))


def exact_median(df: DataFrame, entity: str, value: str) -> DataFrame:
    """The median rounded to a whole number, over values that are not null."""
    return df.groupBy(entity).agg(F.round(F.median(value), 0).alias("median"))


def prefer(low: DataFrame, high: DataFrame, key: str, value: str) -> DataFrame:
    """Full outer join; low's value counts where it has one."""
    a, b = low.select(key, F.col(value).alias("_a")), high.select(key, F.col(value).alias("_b"))
    return a.join(b, key, "full").select(key, F.coalesce("_a", "_b").alias(value))


def strategies(entities: DataFrame, entity: str, rank: str, points: str, tiles: str, direct: int = 300, few: int = 100, low: Sequence[str] = LOW_RANKS) -> DataFrame:
    """Adds how an entity's centroids are made: direct_raw, raw_fallback or weighted_tiles."""
    raw = ~F.upper(rank).isin(*low) & (F.col(points) >= direct)
    return entities.withColumn("strategy", F.when(raw, "direct_raw").when(F.coalesce(tiles, F.lit(0)) < few, "raw_fallback").otherwise("weighted_tiles"))


def package(tiles: DataFrame, entity: str, profile: DataFrame | None = None, few: int = 20) -> DataFrame:
    """(entity, habitat, max, avg, observations[, elevation_profile]): JSON lists, tiles under `few` points last."""
    order = F.struct((F.col("n") < few).cast("int").alias("a"), (-F.col("n")).alias("b"), "lng", "lat")
    lists = F.transform(F.array_sort(F.collect_list(order)), lambda x: F.struct(x.lng.alias("lng"), x.lat.alias("lat"), (-x.b).alias("occ")))
    out = tiles.groupBy(entity).agg(F.to_json(lists).alias("habitat"), F.max("n").alias("max"), F.avg("n").alias("avg"), F.sum("n").alias("observations"))
    if profile is None:
        return out
    bins = F.array_sort(F.collect_list(F.struct(F.col("bin").alias("elevation"), F.col("n").alias("occ"))))
    return out.join(profile.where("bin IS NOT NULL").groupBy(entity).agg(F.to_json(bins).alias("elevation_profile")), entity, "left")


def embed(df: DataFrame, packed: DataFrame, key: str, accepted: Column, out: str = "geo") -> DataFrame:
    """Adds the packed row as a JSON object (nulls stay) to accepted rows."""
    fields = [c for c in packed.columns if c != key]
    body = packed.select(key, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(out))
    return df.join(body, key, "left").withColumn(out, F.when(accepted, F.col(out)))
