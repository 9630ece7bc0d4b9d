"""State to region lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The 27 federal units by region.
REGIONS = {
    "North": ("AC", "AM", "AP", "PA", "RO", "RR", "TO"),
    "Northeast": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Center-West": ("DF", "GO", "MS", "MT"),
    "Southeast": ("ES", "MG", "RJ", "SP"),
    "South": ("PR", "RS", "SC"),
}


def state_regions(spark: SparkSession) -> DataFrame:
    """27 rows: ``customer_state``, ``region``."""
    rows = [(state, region) for region, states in REGIONS.items() for state in states]
    return spark.createDataFrame(rows, "customer_state string, region string")
