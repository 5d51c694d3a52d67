"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ZONE = r"([zZ]|[+-]\d{2}(:?\d{2})?)$"


def iso_micros(text: Column) -> Column:
    """Epoch microseconds of an ISO date-time string; null where it is null, blank or no date-time.

    Offsets may be ``Z``, ``+05:30``, ``+0530`` or ``+05``; a string without offset means UTC.
    """
    s = F.trim(text)
    s = F.regexp_replace(s, r"([T ]\d{2}:\d{2}.*[+-]\d{2})(\d{2})$", "$1:$2")
    s = F.regexp_replace(s, r"([T ]\d{2}:\d{2}.*[+-]\d{2})$", "$1:00")
    zoned = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]") & ~s.rlike(_ZONE), F.concat(s, F.lit("Z"))).when(
        s.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(s, F.lit("T00:00:00Z"))
    ).otherwise(s)
    return F.unix_micros(zoned.try_cast("timestamp"))


def micros(df, name: str) -> Column:
    """Epoch microseconds of the timestamp column ``name``; naive timestamps mean UTC."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name))
    return iso_micros(F.col(name).cast("string"))


def month_utc(us: Column) -> Column:
    """``YYYY-MM`` in UTC of epoch microseconds, whatever the session time zone."""
    day = F.floor(us / F.lit(86_400_000_000)).cast("int")
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), day), "yyyy-MM")
