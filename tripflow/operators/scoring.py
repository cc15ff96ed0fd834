"""Batch scoring with a Python model, and scoring of JSON rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.operators.regression import TrainedModel


def score_batches(
    df: DataFrame,
    model: Callable[[pd.DataFrame], pd.Series],
    output: str,
    output_type: T.DataType | None = None,
) -> DataFrame:
    """Apply a pandas model batch by batch; all input columns stay.

    Arrow batches stream through each task, so a partition is never held whole.
    """
    schema = T.StructType(
        [*df.schema.fields, T.StructField(output, output_type or T.DoubleType())]
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{output: model(batch)})

    return df.mapInPandas(run, schema)


def _decoded(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Add ``_row``: a JSON object as a struct of ``schema``, NULL if it is malformed.

    Names match without regard to case. Malformed is what is no JSON object,
    lacks a declared input, or holds a value that does not fit its type.

    Each text is parsed once and each value cast once. Every step is a select
    of its own, and the first and the last pass through an ``inline``: Spark
    would else repeat what they hold in all that refers to it, filters too.
    """
    def once(df: DataFrame, value: Column, name: str) -> DataFrame:
        return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))

    kept, names = df.columns, schema.names
    df = once(df, F.from_json(text, "map<string,string>"), "_fields")
    df = df.select(
        *kept,
        F.transform(F.map_keys("_fields"), F.lower).alias("_names"),
        F.map_values("_fields").alias("_values"),
    )
    at = {n: F.array_position("_names", n.lower()).cast("int") for n in names}
    df = df.select(*kept, "_values", *(at[n].alias(f"_at_{n}") for n in names))
    sent = (F.get("_values", F.col(f"_at_{n}") - 1).alias(f"_sent_{n}") for n in names)
    df = df.select(*kept, *(f"_at_{n}" for n in names), *sent)
    cast = (F.col(f"_sent_{f.name}").try_cast(f.dataType).alias(f"_cast_{f.name}") for f in schema)
    df = df.select("*", *cast)
    fits = (
        (F.col(f"_at_{n}") > 0) & (F.col(f"_sent_{n}").isNull() | F.col(f"_cast_{n}").isNotNull())
        for n in names
    )
    row = F.struct(*(F.col(f"_cast_{n}").alias(n) for n in names))
    return once(df, F.when(reduce(and_, fits), row), "_row").select(*kept, "_row")


def score_json(
    df: DataFrame, model: TrainedModel, schema: T.StructType, text: str = "value"
) -> DataFrame:
    """Decode JSON feature rows and predict; works on streams too.

    Malformed rows are not scored, see ``_decoded``; ``malformed_json`` has them.
    """
    good = _decoded(df, text, schema).filter("_row IS NOT NULL")
    return model.predict(good.select(*df.columns, *(f"_row.{name}" for name in schema.names)))


def malformed_json(df: DataFrame, schema: T.StructType, text: str = "value") -> DataFrame:
    """The rows that ``score_json`` leaves out, for a quarantine."""
    return _decoded(df, text, schema).filter("_row IS NULL").select(*df.columns)


def score_messages(
    df: DataFrame, model: TrainedModel, schema: T.StructType, text: str = "value"
) -> DataFrame:
    """All messages: inputs and prediction of good ones, the text of others in ``malformed``.

    For streams that keep a quarantine beside what they score, in one pass.
    """
    row = _decoded(df, text, schema)
    inputs = [F.col(f"_row.{name}").alias(name) for name in schema.names]
    bad = F.col("_row").isNull()
    flagged = row.select(*inputs, F.when(bad, F.coalesce(text, F.lit(""))).alias("malformed"))
    scored = model.predict(flagged)
    prediction = F.when(F.col("malformed").isNull(), F.col(model.predicted))
    return scored.withColumn(model.predicted, prediction)
