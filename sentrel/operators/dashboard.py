"""Dashboard figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentrel.functions.text import severity_class

# Statuses of a dataset that has not been normalized.
UNNORMALIZED = ("uploaded", "mapping_required", "ready_to_normalize")


def dashboard_counts(**tables: DataFrame) -> DataFrame:
    """Row count of each named table per scope, in one aggregation and without a cap."""
    tagged = [
        df.select("dataset_id", F.lit(name).alias("kind")) for name, df in tables.items()
    ]
    counts = [
        F.count(F.when(F.col("kind") == name, 1)).alias(name) for name in tables
    ]
    return reduce(DataFrame.unionByName, tagged).groupBy("dataset_id").agg(*counts)


def dataset_state(datasets: DataFrame, incidents: DataFrame) -> DataFrame:
    """Whether each dataset still needs normalization or analysis."""
    found = incidents.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("incidents"))
    incident_count = F.coalesce("incidents", F.lit(0))
    return datasets.join(found, "dataset_id", "left").select(
        "dataset_id",
        "status",
        incident_count.alias("incidents"),
        F.col("status").isin(*UNNORMALIZED).alias("needs_normalization"),
        ((F.col("status") == "normalized") & (incident_count == 0)).alias("needs_analysis"),
    )


def severity_mix(df: DataFrame) -> DataFrame:
    """Rows per scope and severity class."""
    return df.groupBy(
        "dataset_id", severity_class(F.coalesce("severity", F.lit("unknown"))).alias("severity_class")
    ).agg(F.count(F.lit(1)).alias("n"))
