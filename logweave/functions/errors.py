"""Delivery error classes: which failures to retry, and which call for a cooldown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Public client error-code names. Codes listed as retriable only
# carry that label; a code in neither list is retried as well.
RETRIABLE_CODES = [
    "BrokerNotAvailable", "ReplicaNotAvailable", "NetworkException", "RequestTimedOut",
    "LeaderNotAvailable", "NotLeaderForPartition", "UnknownLeaderEpoch", "UnknownTopicOrPart",
    "OffsetNotAvailable", "PreferredLeaderNotAvailable", "EligibleLeadersNotAvailable",
    "ReassignmentInProgress", "StaleBrokerEpoch", "StaleCtrlEpoch", "RebootstrapRequired",
    "KafkaStorageError", "NotEnoughReplicas", "NotEnoughReplicasAfterAppend",
    "ThrottlingQuotaExceeded", "Local_MsgTimedOut", "Local_Transport", "Local_AllBrokersDown",
    "Local_TimedOut", "Local_IsrInsuff", "Local_Retry", "Local_WaitCache", "Local_Resolve",
    "Local_TimedOutQueue", "Local_QueueFull", "Unknown",
]
NON_RETRIABLE_CODES = [
    "MsgSizeTooLarge", "RecordListTooLarge", "TopicAuthorizationFailed",
    "ClusterAuthorizationFailed", "GroupAuthorizationFailed",
    "TransactionalIdAuthorizationFailed", "InvalidRequiredAcks", "InvalidConfig",
    "InvalidRequest", "UnsupportedVersion", "UnsupportedCompressionType", "InvalidRecord",
    "InvalidMsg", "PolicyViolation", "TopicException", "Local_UnknownTopic", "UnknownTopicId",
    "OutOfOrderSequenceNumber", "DuplicateSequenceNumber", "InvalidProducerEpoch",
    "UnknownProducerId", "ProducerFenced",
]
COOLDOWN_CODES = [
    "LeaderNotAvailable", "NotLeaderForPartition", "PreferredLeaderNotAvailable",
    "EligibleLeadersNotAvailable", "BrokerNotAvailable", "ReplicaNotAvailable",
    "KafkaStorageError", "NotEnoughReplicas", "NotEnoughReplicasAfterAppend",
]


def error_class(code: Column) -> Column:
    """``retriable``, ``non_retriable``, ``unlisted``, or null without an error."""
    return F.when(code.isin(NON_RETRIABLE_CODES), "non_retriable").when(
        code.isin(RETRIABLE_CODES), "retriable"
    ).when(code.isNotNull(), "unlisted")


def is_retryable(code: Column, fatal: Column) -> Column:
    """Worth another attempt: not fatal, and not one of the non-retriable codes."""
    return code.isNotNull() & ~F.coalesce(fatal, F.lit(False)) & ~code.isin(NON_RETRIABLE_CODES)


def needs_cooldown(code: Column) -> Column:
    """Partition-level failure: keep the partition out of the choice for a while."""
    return F.coalesce(code.isin(COOLDOWN_CODES), F.lit(False))


def classify_errors(df: DataFrame, code: str = "error_code", fatal: str = "is_fatal") -> DataFrame:
    """Add ``error_class``, ``retryable`` and ``cooldown`` (the last two false without an error).

    The code sets are fixed and compile to hash lookups inside the projection, so no join is needed.
    """
    return df.withColumns(
        {
            "error_class": error_class(F.col(code)),
            "retryable": F.coalesce(is_retryable(F.col(code), F.col(fatal)), F.lit(False)),
            "cooldown": needs_cooldown(F.col(code)),
        }
    )
