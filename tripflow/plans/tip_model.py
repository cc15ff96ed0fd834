"""The tip model: feature table, and the specification trained on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.functions import cast_columns
from tripflow.operators.regression import Spec
from tripflow.schemas import TIP_CATEGORIES, TIP_FEATURE_TYPES, TIP_LABEL, TIP_NUMBERS

TIP_SPEC = Spec(TIP_LABEL, TIP_NUMBERS, TIP_CATEGORIES)

# A feature row as JSON carries the inputs and no label.
TIP_INPUT_SCHEMA = T.StructType(
    [T.StructField(n, t) for n, t in TIP_FEATURE_TYPES.items() if n != TIP_LABEL]
)


def tip_features(
    trips: DataFrame, keep: dict[str, T.DataType] | None = None, strict: bool = True
) -> DataFrame:
    """Typed features of trips with a fare; ``keep`` adds columns, e.g. a row key."""
    charged = trips.filter(F.col("fare_amount") != 0)
    return cast_columns(charged, {**TIP_FEATURE_TYPES, **(keep or {})}, strict)
