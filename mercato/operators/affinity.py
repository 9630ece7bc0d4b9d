"""How many owners share two labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def pair_counts(df: DataFrame, owner: str, label: str, name: str) -> DataFrame:
    """Number of owners per unordered pair of labels (``<label>_a`` < ``<label>_b``).

    An owner's labels form a set that cannot be larger than the label domain. Owners with the
    same set are counted together first, so pairs are formed once per distinct set, not once
    per owner.
    """
    sets = (
        df.groupBy(owner)
        .agg(F.sort_array(F.collect_set(label)).alias("_labels"))
        .filter(F.size("_labels") > 1)
        .groupBy("_labels")
        .agg(F.count(F.lit(1)).alias("_owners"))
    )
    later = F.slice("_labels", F.col("_at") + 2, F.size("_labels"))
    return (
        sets.select("_labels", "_owners", F.posexplode("_labels").alias("_at", f"{label}_a"))
        .select("_owners", f"{label}_a", F.explode(later).alias(f"{label}_b"))
        .groupBy(f"{label}_a", f"{label}_b")
        .agg(F.sum("_owners").alias(name))
    )
