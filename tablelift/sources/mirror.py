"""Make one keyed table identical to another, including removal of extras."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.scale import as_list


def mirror_plan(src: DataFrame, dst: DataFrame, key: str | Sequence[str], fingerprint: str) -> DataFrame:
    """One action per key: copy, update, delete or keep.

    Keys are unique on both sides, so the shuffle cannot be skewed, and only
    the key and the fingerprint travel.
    """
    keys = as_list(key)
    left = src.select(*keys, F.col(fingerprint).alias("__src"), F.lit(True).alias("__in_src"))
    right = dst.select(*keys, F.col(fingerprint).alias("__dst"), F.lit(True).alias("__in_dst"))
    action = (
        F.when(F.col("__in_dst").isNull(), "copy")
        .when(F.col("__in_src").isNull(), "delete")
        .when(F.col("__src").eqNullSafe(F.col("__dst")), "keep")
        .otherwise("update")
    )
    return left.join(right, keys, "full_outer").select(*keys, action.alias("action"))


def apply_mirror(src: DataFrame, dst: DataFrame, plan: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The destination after the plan: kept rows as they are, the rest from the source."""
    keys = as_list(key)
    kept = dst.join(plan.where(F.col("action") == "keep").select(*keys), keys, "left_semi")
    fresh = src.join(plan.where(F.col("action").isin("copy", "update")).select(*keys), keys, "left_semi")
    return kept.select(*src.columns).unionByName(fresh)
