"""JSON encode, strict decode and twice-encoded payloads.

Spark's JSON reader is lenient: it puts the text of a number or an object into a string field, and
stops at the end of the first value. Strictness comes from what it is asked to read. The text is
placed inside an object with a field behind it, so that anything after the value breaks that
object; and string fields are read as variants, which remember whether the value was a string.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

_CORRUPT, _VALUE, _END = "_corrupt", "value", "_end"
_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}

_ELEMENT_OPTIONS = {k: v for k, v in _OPTIONS.items() if k != "columnNameOfCorruptRecord"}


def encode_json(*columns: str) -> Column:
    """UTF-8 JSON bytes of the named columns; absent values are written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary")


def _read(text: Column, schema: T.DataType) -> Column:
    """The text as ``value`` of an object; null if it is not one element of an array.

    Text that goes on behind the value can pass as further fields of the object, but not as a part of an
    array at the same time: a comma would have to be followed by a name with a colon, and by none.
    """
    framed = F.concat(F.lit(f'{{"{_VALUE}":'), text, F.lit(f',"{_END}":0}}'))
    layout = T.StructType(
        [
            T.StructField(_VALUE, schema),
            T.StructField(_END, T.IntegerType()),
            T.StructField(_CORRUPT, T.StringType()),
        ]
    )
    elements = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(T.StringType()), _ELEMENT_OPTIONS)
    return F.when(F.size(elements) == 1, F.from_json(framed, layout, _OPTIONS))


def _is_good(frame: Column) -> Column:
    return frame.isNotNull() & frame[_CORRUPT].isNull() & frame[_END].isNotNull()


def unwrap_json_string(text: Column) -> Column:
    """Text inside a JSON string literal, null if the literal is broken; other text stays as it is."""
    inner = F.transform(
        F.array(_read(text, T.StringType())), lambda f: F.when(_is_good(f), f[_VALUE])
    )
    return F.when(F.ltrim(text).startswith('"'), F.element_at(inner, 1)).otherwise(text)


def _as_read(kind: T.DataType) -> T.DataType:
    """The type with variants in place of strings."""
    if isinstance(kind, T.StringType):
        return T.VariantType()
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _as_read(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_as_read(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _as_read(kind.valueType))
    return kind


def _mismatch(column: Column, kind: T.DataType) -> Column | None:
    """Whether some string field holds anything but a string or null; None if there is no such field."""
    if isinstance(kind, T.StringType):
        return column.isNotNull() & ~F.schema_of_variant(column).isin("STRING", "VOID")
    if isinstance(kind, T.StructType):
        parts = [_mismatch(column[f.name], f.dataType) for f in kind.fields]
        found = [F.coalesce(p, F.lit(False)) for p in parts if p is not None]
        return reduce(lambda a, b: a | b, found) if found else None
    if isinstance(kind, (T.ArrayType, T.MapType)):
        inner = kind.elementType if isinstance(kind, T.ArrayType) else kind.valueType
        if _as_read(inner) == inner:
            return None
        values = column if isinstance(kind, T.ArrayType) else F.map_values(column)
        return F.exists(values, lambda v: _mismatch(v, inner))
    return None


def _restore(column: Column, kind: T.DataType) -> Column:
    """The value under its wanted type, variants turned into text."""
    if _as_read(kind) == kind:
        return column
    if isinstance(kind, T.StringType):
        return F.try_variant_get(column, "$", "string")
    if isinstance(kind, T.StructType):
        fields = [_restore(column[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(column.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda v: _restore(v, kind.elementType))
    return F.transform_values(column, lambda k, v: _restore(v, kind.valueType))


def _error_of(frame: Column, schema: T.StructType) -> Column:
    value = frame[_VALUE]
    bad = F.when(~_is_good(frame), "malformed_json").when(value.isNull(), "null_value")
    mismatch = _mismatch(value, schema)
    return bad if mismatch is None else bad.when(mismatch, "malformed_json")


def parse_json(text: Column, schema: T.StructType) -> Column:
    """The decoded struct, null for anything :func:`decode_json` calls an error."""
    decoded = F.transform(
        F.array(_read(text, _as_read(schema))),
        lambda f: F.when(_error_of(f, schema).isNull(), _restore(f[_VALUE], schema)),
    )
    return F.element_at(decoded, 1)


def decode_json(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    into: str = "data",
    unwrap: bool = False,
) -> DataFrame:
    """Add ``into`` (the decoded struct) and ``_error`` (null for a good row).

    A missing value, the literal ``null``, malformed text, text after the object and fields of
    another type than the schema's are errors; unknown fields are ignored and absent ones are null.
    ``unwrap`` first opens payloads that were serialised to a string twice.
    """
    text = F.col(value).cast("string")
    body = unwrap_json_string(text) if unwrap else text
    frame = F.col("_frame")
    # as the output of a generator the frame is parsed once; a projected one would be copied into
    # every filter on the columns below
    parsed = F.explode(F.array(_read(body, _as_read(schema)))).alias("_frame")
    error = F.when(F.col(value).isNull(), "null_value").when(frame.isNull(), "malformed_json")
    return (
        df.select("*", parsed)
        .withColumn("_error", F.coalesce(error, _error_of(frame, schema)))
        .withColumn(into, F.when(F.col("_error").isNull(), _restore(frame[_VALUE], schema)))
        .drop("_frame")
    )
