"""What names, times and statuses of markets say."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month names in tickers; statuses in which a market doesn't trade any more.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")
TERMINAL = ("closed", "settled", "finalized", "determined")
#: Minutes between open and close of each cadence, inclusive.
CADENCES = (("Hourly", 50, 70), ("Daily", 1380, 1620), ("Weekly", 9360, 10860))

_MONTH = "|".join(MONTHS)


def _month(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(m) for m in MONTHS]), name)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _date_text(y: Column, m: Column, d: Column) -> Column:
    return F.concat(F.lit("20"), y, F.lit("-"), F.lpad(_month(m).cast("string"), 2, "0"), F.lit("-"), d)


def ticker_date(ticker: Column) -> Column:
    """Date of the first -YYMONDD in a ticker; null if there is none or it isn't a date."""
    part = lambda i: F.regexp_extract(ticker, rf"-(\d{{2}})({_MONTH})(\d{{2}})", i)
    return F.when(part(1) != "", _date_text(part(1), part(2), part(3)).try_cast("date"))


def hour_label(ticker: Column) -> Column:
    """<SERIES>-YYMONDDHH of a ticker, null if it has none."""
    got = F.regexp_extract(ticker, rf"^([^-]+-\d{{2}}(?:{_MONTH})\d{{2}}\d{{2}})", 1)
    return F.when(got != "", got)


def event_start_us(ticker: Column) -> Column:
    """UTC microseconds of the -YYMONDDHHMM after the series, which is New York time; else null.

    The zone follows the date alone: from the second Sunday of March to the day before the
    first Sunday of November it is 4 hours behind, else 5.
    """
    rx = rf"^[^-]+(?:-[^-]*)*?-(\d{{2}})({_MONTH})(\d{{2}})(\d{{2}})(\d{{2}})(?!\d)"
    y, m, d, hh, mm = (F.regexp_extract(ticker, rx, i) for i in range(1, 6))
    date = _date_text(y, m, d).try_cast("date")
    year = (F.lit(2000) + _int(y)).cast("string")
    # Days from the 8th of March (1st of November) to the Sunday on or after it.
    sunday = lambda text: F.date_add(text, F.pmod(F.lit(8) - F.dayofweek(text), F.lit(7)))
    start = sunday(F.concat(year, F.lit("-03-08")).try_cast("date"))
    end = sunday(F.concat(year, F.lit("-11-01")).try_cast("date"))
    behind = F.when((date >= start) & (date < end), 4).otherwise(5)
    minutes = (_int(hh) + behind) * 60 + _int(mm)
    us = F.unix_date(date).cast("bigint") * 86_400_000_000 + minutes.cast("bigint") * 60_000_000
    return F.when((y != "") & (_int(hh) < 24) & (_int(mm) < 60), us)


def cadence(minutes: Column) -> Column:
    """Cadence of a market by whole minutes from open to close; Other where unknown."""
    c = F.when(minutes > CADENCES[-1][2], "Long")
    for name, lo, hi in CADENCES:
        c = c.when(minutes.between(lo, hi), name)
    return c.otherwise("Other")


def is_terminal(status: Column) -> Column:
    return F.coalesce(status.isin(*TERMINAL), F.lit(False))


def slug(text: Column) -> Column:
    """Lower case, runs of other than letters and digits to one dash, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^\p{Alnum}]+", "-"), r"^-|-$", "")


def session_name(event: Column, ticker: Column, entry_id: Column) -> Column:
    """The predicted event, else the ticker without its last part, else the id."""
    stem = F.regexp_extract(ticker, r"^(.*)-[^-]*$", 1)
    return F.coalesce(event, F.when(stem != "", stem), entry_id)


def is_safe_segment(text: Column) -> Column:
    """Whether a name can be a path segment: letters, digits, dot, dash, underscore; not dots alone."""
    return F.coalesce(text.rlike(r"^[A-Za-z0-9._-]+$") & ~text.rlike(r"^\.+$"), F.lit(False))


def number_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def price_proxy(bid: Column, ask: Column, last: Column) -> Column:
    """Mid of both quotes, else the last price."""
    return F.coalesce((bid + ask) / 2, last)


def atm_distance(price: Column) -> Column:
    return F.abs(price - 0.5)


def is_hourly(minutes: Column) -> Column:
    return F.coalesce(cadence(minutes) == "Hourly", F.lit(False))


#: Fixed pattern: an RFC 3339 time, with its zone.
RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def rfc3339_us(text: Column) -> Column:
    """Microseconds of an RFC 3339 time, digits beyond them cut off; null for anything else, so that
    no time depends on the session's zone."""
    plain = F.regexp_replace(F.upper(text), r"(\.\d{6})\d+", "$1")
    return F.when(text.rlike(RFC3339), F.unix_micros(F.try_to_timestamp(plain)))


def instant_s(text: Column) -> Column:
    """Unix seconds of a number, an RFC 3339 time or a date (its midnight, UTC); null for others."""
    t = F.trim(text)
    number = F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("bigint"))
    date = F.unix_date(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t.try_cast("date"))).cast("bigint") * 86_400
    time = F.floor(rfc3339_us(t) / 1_000_000)
    return F.coalesce(number, date, time)


def until_s(text: Column) -> Column:
    """The end, exclusive, of a range until a date, which includes that day, or until an instant."""
    return instant_s(text) + F.when(F.trim(text).rlike(r"^\d{4}-\d{2}-\d{2}$"), 86_400).otherwise(0)
