"""Mixed-type distances.

Two ways to work with them:

* **pair tables** ``[id_i, id_j, d]`` for dimensions whose pairs are the result, such as products.  List features
  (customers of a product) grow with the data; they are compared through counts of shared elements and never
  gathered per product.
* **profiles** for customers, which are not paired at all.  With categorical features a distance depends only on the
  set of features in which two customers agree, so sums over customers come from counts per feature value, and sums
  of squares from counts per pair of values; the nearest customer and sums of any function of the distance come from
  one equi-join per set of features.  The results equal the all-pairs ones, for any number of distinct profiles.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scoring
from .joins import self_pairs

NUMERIC, MATCHING, JACCARD = "numeric", "matching", "jaccard"
SMALLEST = 1e-6
METRICS = {
    NUMERIC: scoring.numeric_distance,
    MATCHING: scoring.matching_distance,
    JACCARD: scoring.list_distance,
}


def _with_values(pairs: DataFrame, entities: DataFrame, key: str, cols: list[str]) -> DataFrame:
    for side in ("i", "j"):
        values = entities.select(F.col(key).alias(f"id_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in cols])
        pairs = pairs.join(values, f"id_{side}")
    return pairs


def shared_counts(members: DataFrame, key: str) -> DataFrame:
    """``[id_i, id_j, shared]``: common elements of two entities' lists, pairs without any left out.

    ``members`` is distinct ``[key, element]``.  Elements held by the same set of entities are counted together
    first, by a digest of the set, so the pairs of a set are listed once however many elements share it.  Each
    holder is a row of its own before it meets the others of its set, so a set with many holders is spread over
    tasks."""
    holders = (
        members.where(F.col("element").isNotNull())
        .groupBy("element")
        .agg(F.array_sort(F.collect_list(key)).alias("holders"))
        .where(F.size("holders") > 1)
        .groupBy(F.sha2(F.to_json("holders"), 256).alias("held_by"))
        .agg(F.count(F.lit(1)).alias("n"), F.any_value("holders").alias("holders"))
    )
    each = holders.select("held_by", "n", F.posexplode("holders").alias("at", "id_i"), "holders")
    spread = each.repartition("held_by", "at")
    rest = F.slice("holders", F.col("at") + 2, F.size("holders"))
    return spread.select("id_i", "n", F.explode(rest).alias("id_j")).groupBy("id_i", "id_j").agg(F.sum("n").alias("shared"))


def pairwise_features(
    entities: DataFrame,
    key: str,
    scalars: Mapping[str, str],
    lists: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """``[id_i, id_j, <one distance per feature>]`` over all pairs of a dimension.

    ``scalars`` maps a column to its metric (arrays of bounded length may use the list metric);
    ``lists`` maps a feature with long lists to its distinct ``[key, element]`` table."""
    pairs = _with_values(self_pairs(entities, key), entities, key, list(scalars))
    distances: dict[str, Column] = {
        c: METRICS[metric](F.col(f"{c}_i"), F.col(f"{c}_j")) for c, metric in scalars.items()
    }
    for name, members in (lists or {}).items():
        sizes = members.groupBy(key).agg(F.count("element").alias("n"))
        for side in ("i", "j"):
            pairs = pairs.join(
                sizes.select(F.col(key).alias(f"id_{side}"), F.col("n").alias(f"{name}_n_{side}")), f"id_{side}", "left"
            )
        shared = shared_counts(members, key).withColumnRenamed("shared", f"{name}_shared")
        pairs = pairs.join(shared, ["id_i", "id_j"], "left")
        distances[name] = scoring.jaccard_distance(
            F.coalesce(F.col(f"{name}_shared"), F.lit(0)), F.col(f"{name}_n_i"), F.col(f"{name}_n_j")
        )
    return pairs.select("id_i", "id_j", *[d.alias(c) for c, d in distances.items()])


def dist_numeric(entities: DataFrame, key: str, col: str) -> DataFrame:
    return pairwise_features(entities, key, {col: NUMERIC}).withColumnRenamed(col, "d")


def dist_matching(entities: DataFrame, key: str, col: str) -> DataFrame:
    return pairwise_features(entities, key, {col: MATCHING}).withColumnRenamed(col, "d")


def dist_jaccard(entities: DataFrame, key: str, members: DataFrame) -> DataFrame:
    return pairwise_features(entities, key, {}, {"d": members})


def mean_distance(weights: Mapping[str, float]) -> Column:
    return mean_distance_of([F.col(c) * float(w) for c, w in weights.items()], weights)


def weighted_distance(pairs: DataFrame, weights: Mapping[str, float]) -> DataFrame:
    return pairs.select("id_i", "id_j", mean_distance(weights).alias("d"))


def mirrored(pairs: DataFrame) -> DataFrame:
    """``[a, b, ...]`` with every pair in both directions, in one pass over the pair table."""
    rest = [c for c in pairs.columns if c not in ("id_i", "id_j")]
    both = F.array(
        F.struct(F.col("id_i").alias("a"), F.col("id_j").alias("b")),
        F.struct(F.col("id_j").alias("a"), F.col("id_i").alias("b")),
    )
    return pairs.select(F.inline(both), *rest)


def nearest_entity(pairs: DataFrame, unknown: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``[id, nearest, d]``: the closest known entity of each unknown one, smallest id on ties."""
    return (
        mirrored(pairs)
        .join(unknown.select(F.col(key).alias("a")), "a", "left_semi")
        .join(known.select(F.col(key).alias("b")), "b", "left_semi")
        .groupBy(F.col("a").alias("id"))
        .agg(F.min(F.struct("d", "b")).alias("best"))
        .select("id", F.col("best.b").alias("nearest"), F.col("best.d").alias("d"))
    )


def _raw_weight(weighting: str) -> Column:
    d = F.greatest(F.col("d"), F.lit(SMALLEST))
    return 1 / d if weighting == "inverse" else d


def affinity_weights(
    pairs: DataFrame, targets: DataFrame, sources: DataFrame, key: str, weighting: str = "inverse"
) -> DataFrame:
    """``[target, source, w]`` with weights of one target summing to 1.

    ``weighting="inverse"`` favours near sources; ``"distance"`` weighs by the distance itself."""
    raw = (
        mirrored(pairs)
        .join(targets.select(F.col(key).alias("a")), "a", "left_semi")
        .join(sources.select(F.col(key).alias("b")), "b", "left_semi")
        .select(F.col("a").alias("target"), F.col("b").alias("source"), _raw_weight(weighting).alias("raw"))
    )
    totals = raw.groupBy("target").agg(F.sum("raw").alias("total"))
    return raw.join(totals, "target").select("target", "source", (F.col("raw") / F.col("total")).alias("w"))


# Profiles: exact results for any number of entities with categorical features.


def with_profile(entities: DataFrame, cols: list[str]) -> DataFrame:
    """Add ``profile``, a text key of the feature values (nulls are kept apart)."""
    return entities.withColumn("profile", F.to_json(F.struct(*cols)))


def agreements(weights: Mapping[str, float]) -> list[tuple[list[str], float]]:
    """Every set of features that two entities can agree in, with their distance if they agree in no other."""
    cols, total = list(weights), float(sum(weights.values()))
    sets = []
    for bits in range(1 << len(cols)):
        same = [c for i, c in enumerate(cols) if bits >> i & 1]
        sets.append((same, sum(float(weights[c]) for c in cols if c not in same) / total))
    return sets


def agreement_keys(df: DataFrame, sets: list[list[str]], keep: list[str]) -> DataFrame:
    """``[*keep, s, v]``: for each feature set (number s) the row's values as one key; a null agrees with nothing."""
    keys = []
    for s, cols in enumerate(sets):
        there = F.lit(True)
        for c in cols:
            there = there & F.col(c).isNotNull()
        keys.append(F.when(there, F.struct(F.lit(s).alias("s"), F.to_json(F.array(*[F.col(c).cast("string") for c in cols])).alias("v"))))
    return df.select(*keep, F.inline(F.filter(F.array(*keys), lambda k: k.isNotNull())))


def per_set(values: list[float]) -> Column:
    """The value that belongs to a row's feature set ``s``."""
    return F.element_at(F.array(*[F.lit(float(x)) for x in values]), F.col("s") + 1)


def own_distance(weights: Mapping[str, float]) -> Column:
    """Distance of an entity to one with its own values: its missing values count."""
    return mean_distance_of([F.when(F.col(c).isNull(), 1.0).otherwise(0.0) * float(w) for c, w in weights.items()], weights)


def mean_distance_of(parts: list[Column], weights: Mapping[str, float]) -> Column:
    weighted = parts[0]
    for part in parts[1:]:
        weighted = weighted + part
    return weighted / float(sum(weights.values()))


def nearest_by_profile(unknown: DataFrame, known: DataFrame, key: str, weights: Mapping[str, float]) -> DataFrame:
    """``nearest_entity`` for many entities: ``[id, nearest, d]``, smallest id on ties.

    For each feature set the smallest known id per value key is joined; the least distance over the sets is exact, as
    whoever agrees in more features is found under the larger set too.  There are 2^(features) sets."""
    cols, sets = list(weights), agreements(weights)
    same = [s for s, _ in sets]
    picks = agreement_keys(known, same, [key]).groupBy("s", "v").agg(F.min(key).alias("nearest"))
    profiles = with_profile(unknown, cols).select("profile", *cols).distinct()
    found = agreement_keys(profiles, same, ["profile"]).join(picks, ["s", "v"]).withColumn("d", per_set([d for _, d in sets]))
    best = found.groupBy("profile").agg(F.min(F.struct("d", "nearest")).alias("best"))
    return with_profile(unknown, cols).join(best, "profile").select(F.col(key).alias("id"), "best.nearest", "best.d")
