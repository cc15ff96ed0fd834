"""Column functions. All of them are built-in expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def truncate(unit: str, ts: Column | str) -> Column:
    """Start of the hour, day or month, without time zone.

    ``date_trunc`` returns a zoned timestamp even for zone-less input, hence
    the cast back. The session runs in UTC, so no clock change can shift it.
    """
    return F.date_trunc(unit, ts).cast(T.TimestampNTZType())


def hours(seconds: Column | str) -> Column:
    """Seconds as fractional hours."""
    return (F.col(seconds) if isinstance(seconds, str) else seconds) / 3600


def replace_text(col: Column | str, old: str, new: str) -> Column:
    """Literal substring replacement."""
    return F.replace(F.col(col) if isinstance(col, str) else col, F.lit(old), F.lit(new))


def surrogate_key(*cols: str) -> Column:
    """MD5 over the column texts joined by a dash; NULL counts as empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def code_description(code: Column | str, descriptions: dict) -> Column:
    """Text of a code, NULL for codes without one."""
    code = F.col(code) if isinstance(code, str) else code
    first, *rest = descriptions.items()
    start = F.when(code == first[0], first[1])
    return reduce(lambda chain, item: chain.when(code == item[0], item[1]), rest, start)


def as_type(col: Column, source: T.DataType, target: T.DataType, strict: bool = True) -> Column:
    """Cast with warehouse rounding.

    A plain Spark cast cuts fractions off when it makes an integer; here they
    are rounded half-even first. With ``strict=False`` values that do not fit
    become NULL, otherwise they raise.
    """
    if source == target:
        return col
    if isinstance(target, T.IntegralType) and isinstance(source, (T.FractionalType, T.DecimalType)):
        col = F.bround(col)
    return col.cast(target) if strict else col.try_cast(target)


def cast_columns(df: DataFrame, types: dict[str, T.DataType], strict: bool = True) -> DataFrame:
    """Exactly the columns of ``types``, in that order and with those types."""
    sources = {f.name.lower(): f.dataType for f in df.schema.fields}
    return df.select(
        *(
            as_type(F.col(name), sources[name.lower()], target, strict).alias(name)
            for name, target in types.items()
        )
    )


def encode_json(*cols: str) -> Column:
    """The given columns as one JSON object."""
    return F.to_json(F.struct(*cols))


def decode_json(text: Column | str, schema: T.StructType) -> Column:
    """JSON text as a struct of ``schema`` plus a corrupt-record field.

    Malformed text gives NULL fields and the text itself in the extra field,
    so callers can tell it from a message whose fields are NULL.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(
        text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
