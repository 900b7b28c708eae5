"""Tile histograms over points derived from events and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from quorate.functions import geo
from quorate.operators import clustering, tiles
from quorate.plans.base import query

_XY = """
pts AS (SELECT user_id % 40 AS entity, round((event_id * 37 % 3600) / 10.0 - 180, 3)::DOUBLE AS lng, round((event_id * 53 % 1780) / 10.0 - 89, 3)::DOUBLE AS lat, value FROM events),
ok AS (SELECT * FROM pts WHERE NOT (lng = 0 AND lat = 0) AND NOT (lng = 1 AND lat = 1)),
places AS (SELECT entity, lng, lat, count(*) AS n FROM ok GROUP BY ALL),
placed AS (SELECT *, CAST(floor(least(greatest((lng + 180) / 360 * 8, 0), 7)) AS BIGINT) * 8 + CAST(floor(least(greatest((1 - ln(tan(radians(least(greatest(lat, -85.05112878), 85.05112878))) + 1 / cos(radians(least(greatest(lat, -85.05112878), 85.05112878)))) / pi()) / 2 * 8, 0), 7)) AS BIGINT) AS tile FROM places),
seeds AS (SELECT entity, tile, (min(lng) + max(lng)) / 2 AS lng, (min(lat) + max(lat)) / 2 AS lat, CAST(sum(n) AS BIGINT) AS n FROM placed GROUP BY ALL)"""


def _points(t):
    e = F.col("event_id")
    return geo.usable_points(t.events.select((F.col("user_id") % 40).alias("entity"), ((e * 37 % 3600) / 10.0 - 180).alias("lng"), ((e * 53 % 1780) / 10.0 - 89).alias("lat"), "value"))


def _seeds(t):
    return tiles.seed_tiles(_points(t), "entity", zoom=3)


@query(f"WITH {_XY} SELECT entity, tile, round(lng, 6) AS lng, round(lat, 6) AS lat, n FROM seeds")
def tile_histogram(t):
    """Points of each entity and tile; equal points are counted before tiles are computed."""
    return _seeds(t).select("entity", "tile", F.round("lng", 6).alias("lng"), F.round("lat", 6).alias("lat"), "n")


@query(f"""
WITH {_XY}, e AS (SELECT entity, 100 + entity % 4 AS up FROM (SELECT DISTINCT entity FROM seeds)),
s AS (SELECT *, CASE WHEN n > 6 THEN 'u:' || tile || '#' || entity ELSE 'm:' || tile END AS key FROM seeds),
m AS (SELECT up, tile, key, arg_max(struct_pack(lng := lng, lat := lat), struct_pack(a := n, b := -lng, c := -lat)) AS c, CAST(sum(n) AS BIGINT) AS n FROM s JOIN e USING (entity) GROUP BY ALL)
SELECT entity, tile, round(lng, 6) AS lng, round(lat, 6) AS lat, n FROM seeds UNION ALL SELECT up, tile, round(c.lng, 6), round(c.lat, 6), n FROM m""")
def tile_guarded_merge(t):
    """Tiles rolled up to parents; heavy ones keep their own key."""
    seeds = _seeds(t)
    edges = seeds.select("entity").distinct().withColumn("up", F.lit(100) + F.col("entity") % 4)
    out = tiles.guarded_rollup(seeds, edges, "entity", "entity", "up", heavy=6)
    return out.select("entity", "tile", F.round("lng", 6).alias("lng"), F.round("lat", 6).alias("lat"), "n")


@query(f"""
WITH {_XY}, w AS (SELECT entity FROM seeds GROUP BY entity HAVING count(*) > 30 AND count(*) FILTER (WHERE n < 5) > 0),
h AS (SELECT entity, (tile // 8 // 2) * 8 + (tile % 8) // 2 AS tile, sum(lng * n) / sum(n) AS lng, sum(lat * n) / sum(n) AS lat, CAST(sum(n) AS BIGINT) AS n FROM seeds WHERE entity IN (SELECT entity FROM w) AND n < 5 GROUP BY ALL)
SELECT entity, tile, round(lng, 6) AS lng, round(lat, 6) AS lat, n FROM seeds WHERE entity NOT IN (SELECT entity FROM w) OR n >= 5 UNION ALL SELECT entity, tile, round(lng, 6), round(lat, 6), n FROM h""")
def tile_coarsen(t):
    """Light tiles of wide entities at half the resolution."""
    out = tiles.coarsen(_seeds(t), "entity", most=30, heavy=5, zoom=3, rounds=1)
    return out.select("entity", "tile", F.round("lng", 6).alias("lng"), F.round("lat", 6).alias("lat"), "n")


_BINS = "bins AS (SELECT l_suppkey, CAST(floor((l_extendedprice - 30000) / 1000.0) * 1000 AS BIGINT) AS bin, count(*) AS n FROM lineitem GROUP BY ALL)"


def _bins(t):
    rows = t.lineitem.select("l_suppkey", (F.col("l_extendedprice") - 30000).alias("x"))
    return tiles.histogram(rows, "l_suppkey", "x", 1000)


@query(f"WITH {_BINS} SELECT * FROM bins")
def bin_profile(t):
    """Histogram of each supplier; negative values floor down."""
    return _bins(t)


@query(f"""
WITH {_BINS}, c AS (SELECT *, sum(n) OVER (PARTITION BY l_suppkey ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY l_suppkey) AS every FROM bins)
SELECT l_suppkey, min(bin) AS median FROM c WHERE cum >= (every + 1) / 2.0 GROUP BY 1""")
def weighted_median(t):
    """Median bin of each histogram."""
    return tiles.weighted_median(_bins(t), "l_suppkey")


@query("SELECT o_custkey, round(median(o_totalprice), 0) AS median FROM orders GROUP BY 1")
def exact_median(t):
    return tiles.exact_median(t.orders, "o_custkey", "o_totalprice")


@query(f"""
WITH {_BINS}, c AS (SELECT *, sum(n) OVER (PARTITION BY l_suppkey ORDER BY bin) AS cum, sum(n) OVER (PARTITION BY l_suppkey) AS every FROM bins),
h AS (SELECT l_suppkey, CAST(min(bin) AS DOUBLE) AS median FROM c WHERE cum >= (every + 1) / 2.0 GROUP BY 1), l AS (SELECT l_suppkey, round(median(l_extendedprice), 0) AS median FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1)
SELECT coalesce(l.l_suppkey, h.l_suppkey) AS l_suppkey, coalesce(l.median, h.median) AS median FROM l FULL JOIN h USING (l_suppkey)""")
def preferred_medians(t):
    """Exact medians where there are some, else the histogram's."""
    low = tiles.exact_median(t.lineitem.where("l_suppkey % 2 = 0"), "l_suppkey", "l_extendedprice")
    high = tiles.weighted_median(_bins(t), "l_suppkey").withColumn("median", F.col("median").cast("double"))
    return tiles.prefer(low, high, "l_suppkey", "median")


@query(f"WITH {_XY} SELECT entity, CASE WHEN entity % 2 = 0 AND sum(n) >= 30 THEN 'direct_raw' WHEN count(*) < 40 THEN 'raw_fallback' ELSE 'weighted_tiles' END AS strategy FROM seeds GROUP BY entity")
def centroid_strategies(t):
    """How each entity's centroids are made."""
    rows = _seeds(t).groupBy("entity").agg(F.sum("n").alias("points"), F.count("*").alias("tiles")).withColumn("rank", F.when(F.expr("entity % 2 = 0"), "GENUS").otherwise("SPECIES"))
    return tiles.strategies(rows, "entity", "rank", "points", "tiles", direct=30, few=40).select("entity", "strategy")


@query(f"""
WITH {_XY} SELECT entity, max(n) AS max, round(avg(n), 6) AS avg, CAST(sum(n) AS BIGINT) AS observations, count(*) AS tiles, CAST(first(n ORDER BY n < 5, n DESC, lng, lat) AS BIGINT) AS top FROM seeds GROUP BY entity""")
def package_nested_json(t):
    """Habitat lists as JSON, read back."""
    out = tiles.package(_seeds(t), "entity", few=5)
    return out.select("entity", "max", F.round("avg", 6).alias("avg"), "observations", F.json_array_length("habitat").cast("long").alias("tiles"), F.get_json_object("habitat", "$[0].occ").cast("long").alias("top"))


@query(f"""
WITH {_XY}, p AS (SELECT entity, max(n) AS max, CAST(sum(n) AS BIGINT) AS observations FROM seeds GROUP BY entity)
SELECT DISTINCT user_id % 50 AS entity, CASE WHEN (user_id % 50) % 2 = 0 AND p.entity IS NOT NULL THEN '{{"max":' || p.max || ',"observations":' || p.observations || ',"note":null}}' END AS geo FROM events LEFT JOIN p ON p.entity = user_id % 50""")
def embed_json(t):
    """The packed row as a JSON object of accepted rows; null members stay."""
    packed = _seeds(t).groupBy("entity").agg(F.max("n").alias("max"), F.sum("n").alias("observations")).withColumn("note", F.lit(None).cast("string"))
    rows = t.events.select((F.col("user_id") % 50).alias("entity")).distinct()
    return tiles.embed(rows, packed, "entity", F.expr("entity % 2 = 0"))


@query()
def kmeans_centroids(t):
    """Up to three representative points of each entity, from its tiles."""
    return clustering.centroids(_seeds(t), "entity")
