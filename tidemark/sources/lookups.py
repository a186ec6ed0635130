"""The state lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The state names and their two-letter postal codes.
STATES = {
    "Alabama": "AL",
    "Alaska": "AK",
    "Arizona": "AZ",
    "Arkansas": "AR",
    "California": "CA",
    "Colorado": "CO",
    "Connecticut": "CT",
    "Delaware": "DE",
    "District of Columbia": "DC",
    "Florida": "FL",
    "Georgia": "GA",
    "Hawaii": "HI",
    "Idaho": "ID",
    "Illinois": "IL",
    "Indiana": "IN",
    "Iowa": "IA",
    "Kansas": "KS",
    "Kentucky": "KY",
    "Louisiana": "LA",
    "Maine": "ME",
    "Maryland": "MD",
    "Massachusetts": "MA",
    "Michigan": "MI",
    "Minnesota": "MN",
    "Mississippi": "MS",
    "Missouri": "MO",
    "Montana": "MT",
    "Nebraska": "NE",
    "Nevada": "NV",
    "New Hampshire": "NH",
    "New Jersey": "NJ",
    "New Mexico": "NM",
    "New York": "NY",
    "North Carolina": "NC",
    "North Dakota": "ND",
    "Ohio": "OH",
    "Oklahoma": "OK",
    "Oregon": "OR",
    "Pennsylvania": "PA",
    "Rhode Island": "RI",
    "South Carolina": "SC",
    "South Dakota": "SD",
    "Tennessee": "TN",
    "Texas": "TX",
    "Utah": "UT",
    "Vermont": "VT",
    "Virginia": "VA",
    "Washington": "WA",
    "West Virginia": "WV",
    "Wisconsin": "WI",
    "Wyoming": "WY",
}


def states(spark: SparkSession) -> DataFrame:
    """The lookup as a table (state, alpha2), hinted for broadcast: 51 rows."""
    rows = spark.createDataFrame(list(STATES.items()), "state string, alpha2 string")
    return F.broadcast(rows)


def name_of(df: DataFrame, text: str, dimension: DataFrame, name: str, code: str, into: str) -> DataFrame:
    """Resolve a name or a code to the name; unknown text gives NULL."""
    spellings = dimension.select(F.col(name).alias("_text"), F.col(name).alias(into)).union(
        dimension.select(F.col(code).alias("_text"), F.col(name).alias(into))
    )
    return df.join(spellings, F.col(text) == F.col("_text"), "left").drop("_text")


def state_name_of(text: Column | str) -> Column:
    """State name of a name or postal code, NULL if it is neither."""
    pairs = [F.lit(x) for name, code in STATES.items() for x in (name, name, code, name)]
    return F.try_element_at(F.create_map(*pairs), F.col(text) if isinstance(text, str) else text)
