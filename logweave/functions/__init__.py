"""Column expressions for keys, headers, payloads, error codes and scores."""

from logweave.functions.codec import (
    Codec,
    codec,
    int64_codec,
    json_codec,
    order_event_codec,
    string_codec,
    twice_encoded_json_codec,
)
from logweave.functions.errors import classify_errors, is_retryable, needs_cooldown
from logweave.functions.headers import header_array, header_last, sequence_error, sequence_id
from logweave.functions.json_codec import decode_json, encode_json, parse_json, unwrap_json_string
from logweave.functions.keys import (
    decode_int64,
    encode_int64,
    partition_by_suffix,
    partition_error,
)
from logweave.functions.order_event import (
    decode_order_events,
    encode_order_events,
    state_name,
    state_number,
)
from logweave.functions.score import partition_score

__all__ = [
    "Codec", "classify_errors", "codec", "decode_int64", "decode_json", "decode_order_events",
    "encode_int64", "encode_json", "encode_order_events", "header_array", "header_last",
    "int64_codec", "is_retryable", "json_codec", "needs_cooldown", "order_event_codec", "parse_json", "partition_by_suffix",
    "partition_error", "partition_score", "sequence_error", "sequence_id", "state_name",
    "state_number", "string_codec", "twice_encoded_json_codec", "unwrap_json_string",
]
