"""Time, date and number column builders (SC-1..SC-5, SC-9, SC-11, SC-12, JSN-2).

GTFS keeps time of day as text that may pass 24:00 (a trip that leaves at
23:50 and arrives 00:30 the next morning is written ``24:30:00``), dates
as ``YYYYMMDD`` text, and GTFS-RT sends 64-bit numbers either as plain
JSON numbers or as ``{low, high, unsigned}`` objects.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tramline.functions import _col

# The reference's Monday week epoch, its on-time threshold
# (seconds) and the text pattern its SQL engine accepts as a time of day.
WEEK_EPOCH = "2024-01-01"
ON_TIME_THRESHOLD_S = 120
SQLITE_TIME_OF_DAY = r"^([01][0-9]|2[0-4]):[0-5][0-9](:[0-5][0-9](\.[0-9]+)?)?$"
HMS_TEXT = r"^([0-9]+):([0-9]{2}):([0-9]{2})$"
# Train category from route_short_name: leading IC / S / L not followed by
# another letter (IC-01, S1, L 12); anything else is 'Other'.
CATEGORY_PATTERN = r"^(IC|S|L)([^A-Za-z]|$)"
OTHER_CATEGORY = "Other"


def hour_of_text_time(c) -> Column:
    """SC-1: the two-digit hour of an ``HH:MM[:SS]`` text, as text.

    Matches the reference's ``strftime('%H', t)``: '24' for 24:xx, NULL for
    hours of 25 and more, for one-digit hours and for anything malformed.
    Never raises (``hour()`` on a string would fail on ``25:30:00``).
    """
    c = _col(c)
    return F.when(c.rlike(SQLITE_TIME_OF_DAY), F.substring(c, 1, 2))


def service_seconds(c) -> Column:
    """SC-2: seconds since the start of the service day, past midnight kept.

    ``25:30:00`` -> 91800. NULL when the text is not ``H+:MM:SS``.
    """
    c = _col(c)
    ok = c.rlike(HMS_TEXT)
    h = F.regexp_extract(c, HMS_TEXT, 1).try_cast("int")
    m = F.regexp_extract(c, HMS_TEXT, 2).cast("int")
    s = F.regexp_extract(c, HMS_TEXT, 3).cast("int")
    return F.when(ok, h * 3600 + m * 60 + s)


def parse_compact_date(c) -> Column:
    """SC-3/SC-4: ``YYYYMMDD`` text -> DATE; impossible dates -> NULL."""
    c = _col(c)
    return F.when(c.rlike(r"^[0-9]{8}$"), F.try_to_date(c, "yyyyMMdd"))


def week_bucket(d, epoch: str = WEEK_EPOCH, floor: bool = False) -> Column:
    """SC-5: whole weeks since a fixed Monday.

    Default truncates toward zero like the reference (``CAST(x/7 AS INT)``),
    so the six days before the epoch also land in week 0; ``floor=True``
    gives the calendar-correct bucket.
    """
    days = F.datediff(_col(d), F.lit(_dt.date.fromisoformat(epoch)))
    if floor:
        return F.floor(days / F.lit(7)).cast("int")
    return (days / F.lit(7)).cast("int")


def classify_frequency(days) -> Column:
    """SC-6: typical operating days per week -> frequency class."""
    days = _col(days)
    return (F.when(days >= 5, F.lit("High Frequency"))
            .when(days >= 2, F.lit("Medium Frequency"))
            .otherwise(F.lit("Low Frequency/Special")))


def frequency_rank(cat) -> Column:
    """S-2: presentation order of the frequency classes."""
    cat = _col(cat)
    return (F.when(cat == "High Frequency", 1)
            .when(cat == "Medium Frequency", 2).otherwise(3))


def decode_long(c) -> Column:
    """JSN-2: a 64-bit field read as STRING -> BIGINT.

    A plain number stays itself; a protobuf Long object gives
    ``(high << 32) | (low & 0xFFFFFFFF)`` with absent parts 0; ``unsigned``
    is ignored. NULL stays NULL; text that is neither gives NULL.
    """
    c = _col(c)
    is_obj = F.startswith(F.ltrim(c), F.lit("{"))
    zero = F.lit(0).cast("bigint")

    def combined(parts: Column) -> Column:
        low, high = F.coalesce(parts["low"], zero), F.coalesce(parts["high"], zero)
        return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")))
    # bound to a lambda's variable, the object is parsed once for both halves
    once = F.transform(F.array(F.from_json(c, "low bigint, high bigint")), combined)
    return F.when(is_obj, F.element_at(once, 1)).otherwise(c.try_cast("bigint"))


def epoch_to_ts(c) -> Column:
    """SC-9: epoch seconds (number or Long object) -> naive UTC timestamp.

    NULL-safe; 0 is 1970-01-01, not NULL. Counted from an NTZ literal, so the
    session's time zone plays no part.
    """
    return F.timestamp_add("SECOND", decode_long(c), _EPOCH_NTZ())


def utc_ntz(ts) -> Column:
    """A TIMESTAMP as its naive UTC time, whatever the session's zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), _EPOCH_NTZ())


def _EPOCH_NTZ() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def train_category(short_name) -> Column:
    """SC-11: IC / S / L from the route short name, else 'Other'."""
    cat = F.coalesce(F.regexp_extract(_col(short_name), CATEGORY_PATTERN, 1), F.lit(""))
    return F.when(cat == "", F.lit(OTHER_CATEGORY)).otherwise(cat)


def local_hour(ts, tz: str = "UTC") -> Column:
    """SC-12: hour of a stored-UTC timestamp seen in zone ``tz``."""
    ts = _col(ts)
    if tz == "UTC":
        return F.hour(ts)
    return F.hour(F.from_utc_timestamp(ts.cast("timestamp"), tz))


def on_time_flag(delay, threshold: int = ON_TIME_THRESHOLD_S) -> Column:
    """F-7: TRUE when a delay is recorded and below the threshold.

    NULL (no recorded delay) stays NULL — never counted as on time (T-9).
    Early arrivals (negative delay) are on time.
    """
    delay = _col(delay)
    return F.when(delay.isNotNull(), delay < F.lit(threshold))
