"""Spelling variants and k-means."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quorate.functions.collections import bind, first_mode, ranked_distinct


def reduce_spellings(names: Column, distance: int = 3) -> Column:
    """Each name replaced by the seed of its bucket.

    The most frequent name left (then the alphabetically first) is a seed and
    takes every name within less than `distance` edits, counted in characters.
    Every row runs to the end.
    """

    def ordered(xs: Column) -> Column:
        return F.transform(
            F.array_sort(F.transform(F.array_distinct(xs), lambda v: F.struct((-F.size(F.filter(xs, lambda x: x == v))).alias("n"), v.alias("v")))),
            lambda x: x.v,
        )

    def seeds(xs: Column) -> Column:
        def take(found: Column, v: Column) -> Column:
            near = F.exists(found, lambda s: F.levenshtein(s, v) < distance)
            return F.when(near, found).otherwise(F.array_append(found, v))

        return F.aggregate(ordered(xs), F.array().cast("array<string>"), take)

    def assign(xs: Column) -> Column:
        return bind(seeds(xs), lambda ss: F.transform(xs, lambda x: F.get(F.filter(ss, lambda s: F.levenshtein(s, x) < distance), F.lit(0))))

    return bind(F.array_compact(names), assign)


def cluster_strings(df: DataFrame, key: str, lang: str, name: str, own: Column | None = None, distance: int = 3, most: int = 10, common: str = "en") -> DataFrame:
    """(key, vernacular: map from language to its first names, common_name).

    Names are lower-cased; the record's own name goes. Within a language
    spellings are reduced, ranked by count and cut to `most`; common_name is
    the first of the common language.
    """
    low = df.where(F.col(name).isNotNull()).withColumn("_name", F.lower(F.trim(name))).where("_name <> ''")
    if own is not None:
        low = low.where(~F.col("_name").eqNullSafe(F.lower(own)))
    lists = low.groupBy(key, lang).agg(F.array_sort(F.collect_list("_name")).alias("_names"))
    ranked = lists.select(key, lang, ranked_distinct(reduce_spellings(F.col("_names"), distance), most).alias("_names"))
    packed = F.array_sort(F.collect_list(F.struct(F.col(lang).alias("key"), F.col("_names").alias("value"))))
    out = ranked.where(F.col(lang).isNotNull()).groupBy(key).agg(F.map_from_entries(packed).alias("vernacular"))
    return out.withColumn("common_name", first_mode(F.try_element_at("vernacular", F.lit(common))))


# Fixed values of the representative points: clusters for a total weight below
# a limit, then one more for each step of weight up to a greatest number; the
# most rounds; the square of the reach within which weight counts as a centre's;
# the distance between picks; the share of sparse centres; the picks.
CLUSTERS = ((100, 3), (1_000, 4), (6_000, 5))
CLUSTERS_BEYOND, CLUSTER_STEP, CLUSTERS_MOST = 6, 5_000, 10
ROUNDS = 20
REACH_SQUARED, APART, SPARSE, PICKS = 5.0, 9.0, 0.25, 3


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of each a to each b."""
    return np.square(a[:, None] - b).sum(axis=2)


def _clusters(total: float) -> int:
    limit = CLUSTERS[-1][0]
    beyond = min(CLUSTERS_BEYOND + int((total - limit) // CLUSTER_STEP), CLUSTERS_MOST)
    return next((k for most, k in CLUSTERS if total < most), beyond)


def _centres(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Weighted k-means over distinct points, until no point changes its centre."""
    first = [int(weights.argmax())]
    for _ in range(k - 1):
        far = _squared(points, points[first]).min(axis=1) * weights
        first.append(int(rng.choice(len(points), p=far / far.sum())) if far.any() else int(weights.argmax()))
    centres, own = points[first], None
    for _ in range(ROUNDS):
        nearest = _squared(points, centres).argmin(axis=1)
        if own is not None and np.array_equal(own, nearest):
            break
        own = nearest
        share = np.equal.outer(np.arange(k), own) * weights  # centre, point
        mass = share.sum(axis=1, keepdims=True)
        centres = np.divide(share @ points, mass, out=centres.copy(), where=mass > 0)
    return centres


def representatives(points: np.ndarray, weights: np.ndarray, seed: int = 11) -> np.ndarray:
    """Up to PICKS of the points that stand for all: weighted k-means, then the densest centres that lie apart.

    PICKS points or fewer are returned as they are (distinct). Where too few
    centres lie apart, the densest others follow.
    """
    distinct, place = np.unique(points.astype(float), axis=0, return_inverse=True)
    if len(distinct) <= PICKS:
        return distinct
    weights = np.bincount(place.ravel(), weights, len(distinct))
    centres = _centres(distinct, weights, min(_clusters(weights.sum()), len(distinct)), np.random.default_rng(seed))
    density = (_squared(centres, distinct) <= REACH_SQUARED) @ weights
    open_, picked = density >= np.quantile(density, SPARSE), []
    for others in (False, True):
        if others:
            open_ = np.ones(len(centres), bool)
            open_[picked] = False
        while open_.any() and len(picked) < PICKS:
            best = int(np.where(open_, density, -1.0).argmax())
            picked.append(best)
            open_[best] = False
            if not others:
                open_ &= _squared(centres, centres[[best]])[:, 0] >= APART**2
    return np.unique(distinct[_squared(centres[picked], distinct).argmin(axis=1)], axis=0)


def centroids(tiles: DataFrame, key: str, lng: str = "lng", lat: str = "lat", weight: str = "n") -> DataFrame:
    """(key, lng, lat): representative points of each key from weighted tiles.

    Tiles, not points, meet in a task, so a group is bounded by the map's tiles.
    """
    kind = dict(tiles.dtypes)[key]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["lng", "lat", "n"], kind="stable")
        out = representatives(rows[["lng", "lat"]].to_numpy(float), rows["n"].to_numpy(float))
        return pd.DataFrame({key: [rows[key].iloc[0]] * len(out), "lng": out[:, 0], "lat": out[:, 1]})

    own = tiles.select(key, F.col(lng).alias("lng"), F.col(lat).alias("lat"), F.col(weight).alias("n"))
    return own.groupBy(key).applyInPandas(run, f"{key} {kind}, lng double, lat double")


def enrich(df: DataFrame, key: str, fetch, size: int = 20) -> DataFrame:
    """(key, value): what `fetch` (a list of keys to a dict) returns, in requests of `size` keys.

    fetch is sent to the tasks; it should wait and retry as its service asks.
    """
    kind = dict(df.dtypes)[key]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for i in range(0, len(part), size):
                keys = part[key].iloc[i : i + size].tolist()
                found = fetch(keys)
                yield pd.DataFrame({key: keys, "value": [found.get(k) for k in keys]})

    return df.select(key).where(F.col(key).isNotNull()).distinct().mapInPandas(run, f"{key} {kind}, value string")
