"""Reference dimensions: states, territories and dataset types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# State and territory codes with their names.
STATES = [
    ("01", "Alabama"),
    ("02", "Alaska"),
    ("04", "Arizona"),
    ("05", "Arkansas"),
    ("06", "California"),
    ("08", "Colorado"),
    ("09", "Connecticut"),
    ("10", "Delaware"),
    ("11", "District of Columbia"),
    ("12", "Florida"),
    ("13", "Georgia"),
    ("15", "Hawaii"),
    ("16", "Idaho"),
    ("17", "Illinois"),
    ("18", "Indiana"),
    ("19", "Iowa"),
    ("20", "Kansas"),
    ("21", "Kentucky"),
    ("22", "Louisiana"),
    ("23", "Maine"),
    ("24", "Maryland"),
    ("25", "Massachusetts"),
    ("26", "Michigan"),
    ("27", "Minnesota"),
    ("28", "Mississippi"),
    ("29", "Missouri"),
    ("30", "Montana"),
    ("31", "Nebraska"),
    ("32", "Nevada"),
    ("33", "New Hampshire"),
    ("34", "New Jersey"),
    ("35", "New Mexico"),
    ("36", "New York"),
    ("37", "North Carolina"),
    ("38", "North Dakota"),
    ("39", "Ohio"),
    ("40", "Oklahoma"),
    ("41", "Oregon"),
    ("42", "Pennsylvania"),
    ("44", "Rhode Island"),
    ("45", "South Carolina"),
    ("46", "South Dakota"),
    ("47", "Tennessee"),
    ("48", "Texas"),
    ("49", "Utah"),
    ("50", "Vermont"),
    ("51", "Virginia"),
    ("53", "Washington"),
    ("54", "West Virginia"),
    ("55", "Wisconsin"),
    ("56", "Wyoming"),
    ("60", "American Samoa"),
    ("66", "Guam"),
    ("69", "Commonwealth of the Northern Mariana Islands"),
    ("72", "Puerto Rico"),
    ("78", "United States Virgin Islands"),
]

# The codes above that are territories; the rest, with the
# District of Columbia, make up the default request.
TERRITORIES = ["60", "66", "69", "72", "78"]

# Dataset types.
DATASETS = [
    "EDGES", "ADDR", "FACES", "FEATNAMES", "PLACE", "COUSUB", "TRACT", "BG", "TABBLOCK20", "ZCTA520", "COUNTY",
    "STATE", "CD118", "SLDL", "SLDU", "UNSD", "ELSD", "SCSD",
]

# Datasets requested when none is named.
DEFAULT_DATASETS = ["EDGES", "ADDR", "FEATNAMES"]


def states(spark: SparkSession) -> DataFrame:
    """56 rows: code, name and whether it is a territory."""
    return spark.createDataFrame(STATES, "state_fips string, name string").withColumn(
        "territory", F.col("state_fips").isin(*TERRITORIES)
    )


def datasets(spark: SparkSession) -> DataFrame:
    """18 rows: dataset type and whether it is requested by default."""
    return spark.createDataFrame([(d,) for d in DATASETS], "dataset string").withColumn(
        "by_default", F.col("dataset").isin(*DEFAULT_DATASETS)
    )


def default_states(include_territories: bool = False) -> list[str]:
    """Codes requested when none is named."""
    return [code for code, _ in STATES if include_territories or code not in TERRITORIES]
