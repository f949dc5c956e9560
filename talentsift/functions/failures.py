"""Short texts for failed fetches, and the test for exhausted quota."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talentsift.rules import FAILED, Rules

HTTP, TIMEOUT = "http", "timeout"


def summarize(kind: Column, status_code: Column, error_type: Column, message: Column, rules: Rules) -> Column:
    """One line to show per failure: labelled HTTP status, timeout, or type with the start of its message.

    ``full_text`` keeps what the line leaves out.
    """
    label = F
    for code, meaning in rules.http_labels:
        label = label.when(status_code == code, F.lit(f" ({meaning})"))
    return (
        F.when(kind == HTTP, F.concat(F.lit("HTTP "), status_code.cast("string"), label.otherwise(F.lit(""))))
        .when(kind == TIMEOUT, F.lit("request timed out"))
        .otherwise(F.concat(error_type, F.lit(": "), F.substring(message, 1, rules.message_chars)))
    )


def full_text(error_type: Column, message: Column) -> Column:
    """Type and whole message of a failure, to be stored beside the line; NULL when neither is known."""
    return F.when(error_type.isNotNull() | message.isNotNull(), F.concat_ws(": ", error_type, message))


def is_quota_error(status: Column, error: Column, rules: Rules) -> Column:
    lowered = F.lower(error)
    hit = F.lit(False)
    for marker in rules.quota_markers:
        hit = hit | F.contains(lowered, F.lit(marker))
    return F.coalesce((status == FAILED) & hit, F.lit(False))
