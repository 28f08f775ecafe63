"""Static region dimension: region name, service-delivery-area code, counties."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Region name, SDA code (1..16, no 13) and member counties,
# in the reference's order.
REGIONS: tuple[tuple[str, int, tuple[str, ...]], ...] = (
    ("Blue Mountain", 1, ("Morrow", "Umatilla", "Union")),
    ("Multnomah", 2, ("Multnomah",)),
    ("Marion-Polk-Yamhill", 3, ("Marion", "Polk", "Yamhill")),
    ("North Coast", 4, ("Clatsop", "Tillamook", "Columbia")),
    ("Linn-Benton-Lincoln", 5, ("Linn", "Benton", "Lincoln")),
    ("Lane", 6, ("Lane",)),
    ("South Central", 7, ("Douglas", "Klamath", "Lake")),
    ("South Coast", 8, ("Coos", "Curry")),
    ("Southern", 9, ("Jackson", "Josephine")),
    ("The Gorge", 10, ("Gilliam", "Hood River", "Sherman", "Wasco", "Wheeler")),
    ("Grant-Harney", 11, ("Grant", "Harney")),
    ("Central", 12, ("Crook", "Deschutes", "Jefferson")),
    ("Eastern", 14, ("Baker", "Malheur", "Wallowa")),
    ("Clackamas", 15, ("Clackamas",)),
    ("Washington", 16, ("Washington",)),
)

REGIONS_SCHEMA = "region string, sda int, counties array<string>"


def regions(spark: SparkSession) -> DataFrame:
    """The 15-row dimension as a local relation (size is fixed: safe to broadcast)."""
    return spark.createDataFrame([(r, s, list(c)) for r, s, c in REGIONS], REGIONS_SCHEMA)


def counties(spark: SparkSession) -> DataFrame:
    """County -> region, SDA (36 rows), from exploding ``counties``."""
    from pyspark.sql import functions as F

    return regions(spark).select(F.explode("counties").alias("county"), "region", "sda")
