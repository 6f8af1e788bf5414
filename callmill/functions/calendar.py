"""Clock and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the pattern of every timestamp text in a booking document.
DOCUMENT_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

# The arrival folder and the arrival stamp in a landed name.
ARRIVAL_DATE = "yyyy-MM-dd"
ARRIVAL_STAMP = "yyyy-MM-dd'T'HH-mm-ss"

# What they and an id make up.
LANDED_NAME = r"^\d{4}-\d{2}-\d{2}/\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2}_[0-9a-f-]{36}\.json$"
LANDED_LENGTH = 10 + 1 + 19 + 1 + 36 + 5


def document_timestamp(text: Column) -> Column:
    """Timestamp of a document text; NULL where the text does not fit."""
    return F.try_to_timestamp(text, F.lit(DOCUMENT_TIMESTAMP))


def day_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")


def iso_weekday(ts: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(ts) + F.lit(1)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("bigint")


def arrival_date(now: Column | None = None) -> Column:
    """UTC arrival folder; one clock value per batch."""
    return F.date_format(F.current_timestamp() if now is None else now, ARRIVAL_DATE)


def landed_name(now: Column | None = None) -> Column:
    """``<date>/<stamp>_<random id>.json``, unique per document."""
    now = F.current_timestamp() if now is None else now
    return F.concat(
        arrival_date(now), F.lit("/"), F.date_format(now, ARRIVAL_STAMP), F.lit("_"), F.uuid(), F.lit(".json")
    )
