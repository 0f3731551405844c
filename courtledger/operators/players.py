"""Player dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtledger.functions import birth_date, full_name, handedness
from courtledger.operators.clean import clean_strings


def transform_players(raw: DataFrame) -> DataFrame:
    return clean_strings(raw).select(
        "player_id",
        "name_first",
        "name_last",
        full_name(F.col("name_first"), F.col("name_last")).alias("full_name"),
        handedness(F.col("hand")).alias("hand"),
        birth_date(F.col("dob")).alias("dob"),
        F.col("ioc").alias("country_code"),
        F.col("height").try_cast("int").alias("height_cm"),
    )
