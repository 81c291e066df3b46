"""Static inputs (A4, A5): the size -> credits map and CSV seeds."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Credits per hour by warehouse size and type
# ---------------------------------------------------------------------------
WAREHOUSE_CREDITS = [
    ("X-Small", "STANDARD", 1),
    ("Small", "STANDARD", 2),
    ("Medium", "STANDARD", 4),
    ("Large", "STANDARD", 8),
    ("X-Large", "STANDARD", 16),
    ("2X-Large", "STANDARD", 32),
    ("3X-Large", "STANDARD", 64),
    ("4X-Large", "STANDARD", 128),
    ("5X-Large", "STANDARD", 256),
    ("6X-Large", "STANDARD", 512),
    ("Medium", "SNOWPARK-OPTIMIZED", 6),
    ("Large", "SNOWPARK-OPTIMIZED", 12),
    ("X-Large", "SNOWPARK-OPTIMIZED", 24),
    ("2X-Large", "SNOWPARK-OPTIMIZED", 48),
    ("3X-Large", "SNOWPARK-OPTIMIZED", 96),
    ("4X-Large", "SNOWPARK-OPTIMIZED", 192),
    ("5X-Large", "SNOWPARK-OPTIMIZED", 384),
    ("6X-Large", "SNOWPARK-OPTIMIZED", 768),
]


def warehouse_credits_map(spark: SparkSession) -> DataFrame:
    """Credits per hour, minute and second for each warehouse size and type (18 rows)."""
    base = spark.createDataFrame(WAREHOUSE_CREDITS,
                                 "warehouse_size string, warehouse_type string, credits_per_hour int")
    return base.select("warehouse_size", "warehouse_type", "credits_per_hour",
                       (F.col("credits_per_hour") / 60).alias("credits_per_minute"),
                       (F.col("credits_per_hour") / 3600).alias("credits_per_second"))


MONTHLY_SPEND_SCHEMA = "MONTH date, SERVICE string, SPEND double"


def read_csv_seed(spark: SparkSession, path: str, schema: str = MONTHLY_SPEND_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
