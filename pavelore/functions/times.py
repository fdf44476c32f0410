"""Time functions. Sessions run in UTC."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_to_timestamp(seconds: Column) -> Column:
    """UNIX seconds (number or text) to a timestamp; unreadable text gives null."""
    return F.timestamp_seconds(seconds.try_cast("decimal(20,6)"))


def to_iso8601(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def parse_iso_or_epoch(text: Column) -> Column:
    """Timestamp of an ISO-8601 text or of epoch milliseconds; anything else gives null."""
    millis = F.timestamp_millis(F.when(text.rlike(r"^-?\d{5,}$"), text.try_cast("bigint")))
    return F.coalesce(millis, text.try_cast("timestamp"))


def version_stamp(now: datetime | None = None) -> str:
    """Version name of a saved model, in UTC."""
    moment = (now or datetime.now(timezone.utc)).astimezone(timezone.utc)
    return f"{moment:%Y-%m-%d_%H-%M-%S}_GMT"
