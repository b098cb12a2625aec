"""Pricing of jobs from the machine price list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import rnd
from ..settings import UNKNOWN_MACHINE_CPU_RATE


def with_costs(ev: DataFrame, rates: DataFrame) -> DataFrame:
    """Derive accelerator, hours and cost from machine type and duration.

    Accelerator hours are count x hours (4 digits), cost is rounded to 6.
    A machine that is not listed has no accelerator and the fallback CPU rate.
    """
    prices = rates.select(
        "machine_type",
        F.col("gpu_type").alias("_gpu_type"),
        F.col("gpu_count").alias("_gpu_count"),
        F.col("gpu_rate").alias("_gpu_rate"),
        F.col("cpu_rate").alias("_cpu_rate"),
    )
    hrs = F.col("duration_seconds") / F.lit(3600.0)
    # One projection per step: each step reads columns of the one before it.
    priced = ev.join(prices, "machine_type", "left").withColumns(
        {
            "gpu_type": F.col("_gpu_type"),
            "gpu_count": F.coalesce("_gpu_count", F.lit(0)),
            "cpu_hours": rnd(hrs, 4),
        }
    )
    priced = priced.withColumn("gpu_hours", rnd(F.col("gpu_count") * hrs, 4))
    gpu_cost = F.col("gpu_hours") * F.coalesce("_gpu_rate", F.lit(0.0))
    cpu_cost = F.col("cpu_hours") * F.coalesce("_cpu_rate", F.lit(UNKNOWN_MACHINE_CPU_RATE))
    priced = priced.withColumn("cost_usd", rnd(gpu_cost + cpu_cost, 6))
    return priced.drop("_gpu_type", "_gpu_count", "_gpu_rate", "_cpu_rate")
