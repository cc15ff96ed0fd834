from tripflow.functions.scalars import (
    as_type,
    cast_columns,
    code_description,
    decode_json,
    encode_json,
    hours,
    replace_text,
    surrogate_key,
    truncate,
)

__all__ = [
    "as_type",
    "cast_columns",
    "code_description",
    "decode_json",
    "encode_json",
    "hours",
    "replace_text",
    "surrogate_key",
    "truncate",
]
