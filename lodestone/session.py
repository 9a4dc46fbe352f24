"""Session settings that the plans need."""

from __future__ import annotations

from pyspark.sql import DataFrame


def planned(df: DataFrame) -> DataFrame:
    """df, in a session that doesn't infer constraints.

    The stages alias many nested expressions, and inferring constraints over aliases takes time and memory
    that grow exponentially with them: minutes, where optimizing without it takes a second or two.
    """
    df.sparkSession.conf.set("spark.sql.constraintPropagation.enabled", "false")
    return df
