"""Time helpers, all built-in expressions (JVM side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layout of the capture time column.
CAPTURE_TS_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capture_ts_string(ts: Column | str) -> Column:
    """Timestamp -> capture-time text (``YYYY-MM-DD HH:MM:SS.ffffff``).

    Not ``date_format``: that casts a zone-less timestamp through the session
    time zone and moves wall-clock times that fall into a daylight-saving gap.
    A zone-less timestamp's string cast has no zone step; it trims trailing
    fraction zeros, so the fraction is padded back to six digits. (A zoned
    input is first read as wall-clock time in the session zone, as
    ``date_format`` would.)"""
    s = _col(ts).cast("timestamp_ntz").cast("string")
    return (F.when(F.instr(s, ".") == 0, F.concat(s, F.lit(".000000")))
            .otherwise(F.rpad(s, len("YYYY-MM-DD HH:MM:SS.ffffff"), "0")))


def plus_days(ts: Column | str, days: int | Column) -> Column:
    """``ts + days`` as a day-time interval (keeps zone-less timestamps zone-less)."""
    n = days if isinstance(days, Column) else F.lit(days)
    return _col(ts) + F.make_dt_interval(days=n)


def parse_capture_ts(text: Column | str) -> Column:
    """Capture-time text -> zone-less timestamp; unparseable text -> NULL.

    Accepts ``YYYY-MM-DD HH:MM:SS[.f…]`` and the ISO ``T`` separator. A date
    and time followed by anything else must name a zone (``Z``, ``+05:00``,
    ``Europe/Paris``, ``PST``): the text is an instant, turned into its UTC
    wall-clock time, or NULL if there is no such zone. Other text is read as UTC
    wall-clock time. Neither depends on the session zone.
    """
    c = _col(text)
    clock = r"[0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2}([.][0-9]*)?)?"
    plain = c.rlike(rf"^\s*[+-]?[0-9]{{4,6}}(-[0-9]{{1,2}}(-[0-9]{{1,2}}([ T]({clock})?)?)?)?\s*$")
    zoned = c.rlike(rf"^\s*[+-]?[0-9]{{4,6}}-[0-9]{{1,2}}-[0-9]{{1,2}}[ T]{clock}\s*[^\s0-9.:]")
    micros = F.unix_micros(c.try_cast("timestamp"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    instant = epoch + F.make_dt_interval(secs=(micros.cast("decimal(20,0)") / F.lit(1000000)).cast("decimal(18,6)"))
    return F.when(plain, c.try_cast("timestamp_ntz")).when(zoned, instant)


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Fractional hours from ``start`` to ``end`` (positive when end is later)."""
    micros = F.timestamp_diff("MICROSECOND", _col(start), _col(end))
    return micros / F.lit(3.6e9)


def year_of(ts: Column | str) -> Column:
    return F.year(_col(ts))


def month_of(ts: Column | str) -> Column:
    return F.month(_col(ts))


def calendar_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole calendar days between two timestamps (NULL if either is NULL)."""
    return F.datediff(_col(later), _col(earlier))
