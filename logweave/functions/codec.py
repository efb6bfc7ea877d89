"""Named value codecs: a pair of Column functions each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from logweave.functions.json_codec import parse_json, unwrap_json_string
from logweave.functions.keys import decode_int64, encode_int64
from logweave.functions.order_event import decode_order_event, encode_order_event


@dataclass(frozen=True)
class Codec:
    """``encode`` turns a value column into bytes, ``decode`` turns bytes into a value (null if bad)."""

    encode: Callable[[Column], Column]
    decode: Callable[[Column], Column]


def string_codec() -> Codec:
    return Codec(lambda c: c.cast("binary"), lambda c: c.cast("string"))


def json_codec(schema: T.StructType) -> Codec:
    return Codec(
        lambda c: F.to_json(c, {"ignoreNullFields": "false"}).cast("binary"),
        lambda c: parse_json(c.cast("string"), schema),
    )


def twice_encoded_json_codec(schema: T.StructType) -> Codec:
    """JSON inside a JSON string literal; decoding also takes JSON that was encoded once."""

    def encode(c: Column) -> Column:
        inner = F.to_json(c, {"ignoreNullFields": "false"})
        # a one-element array is the shortest way to a quoted, escaped string
        quoted = F.to_json(F.array(inner))
        return F.substring(quoted, F.lit(2), F.length(quoted) - 2).cast("binary")

    return Codec(encode, lambda c: parse_json(unwrap_json_string(c.cast("string")), schema))


def int64_codec() -> Codec:
    return Codec(encode_int64, decode_int64)


def order_event_codec() -> Codec:
    return Codec(encode_order_event, decode_order_event)


def codec(name: str, schema: T.StructType | None = None) -> Codec:
    """Codec by name: string, json, json2 (twice encoded), order_event, int64."""
    if name in ("json", "json2"):
        if schema is None:
            raise ValueError(f"codec {name} needs a schema")
        return json_codec(schema) if name == "json" else twice_encoded_json_codec(schema)
    plain = {"string": string_codec, "order_event": order_event_codec, "int64": int64_codec}
    return plain[name]()
