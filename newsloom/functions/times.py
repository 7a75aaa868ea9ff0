"""Free-form timestamp text to instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import let, strip

_CLOCK = r"(\d{1,2}:\d{2}:\d{2}(?:\.\d{1,9})?)"
_NO_SECONDS = r"([T ]\d{1,2}:\d{2})(?![\d:])"
_YMD = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})"
_NUMBERS = r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})"  # month first, unless that is no month
_WEEKDAY = r"^(?:[A-Za-z]{3,9},? +)?"
# day, month name, year: the shape used by feeds and HTTP headers
_DMONY = _WEEKDAY + r"(\d{1,2}) ([A-Za-z]{3})[a-z]* (\d{4})"
_MONDY = _WEEKDAY + r"([A-Za-z]{3})[a-z]*\.? +(\d{1,2})(?:st|nd|rd|th)?,? +(\d{4})(?!:)"
_CTIME = _WEEKDAY + r"([A-Za-z]{3})[a-z]* +(\d{1,2}) +(\d{1,2}:\d{2}(?::\d{2})?) +(\d{4})$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})(?:[T ]?(\d{2})(\d{2})(\d{2})?)?(?=$|[ zZ+-])"
_HALF_DAY = r"(\d{1,2}):(\d{2}(?::\d{2}(?:\.\d{1,9})?)?) ?([AaPp])\.?[Mm]\.?"
_OFFSET = r" ?([+-]\d{2}):?(\d{2})$"
_HOURS = r" ?([+-]\d{2})$"
_UTC = r" ?(?:[zZ]|UTC|GMT)$"
_OTHER_ZONE = r" (?!(?:UTC|GMT|AM|PM)$)[A-Z]{3,5}$"  # a name that says no offset is left out

# fixed values: month abbreviations in calendar order
_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _colon_offset(tz: str) -> str:
    """``+0700`` as ``+07:00``."""
    return tz if ":" in tz else f"{tz[:3]}:{tz[3:]}"


def normalize_timestamp(c: Column, default_tz: str = "+0700") -> Column:
    """Instant for a text in one of the known shapes, else null.

    A zone in the text is kept; a text without one, or with a zone name other
    than UTC and GMT, is read in ``default_tz``. The text is rewritten to one
    canonical shape and cast once, so unparsable input costs a failed match and
    not an exception; only texts that are not ISO-like go through the rewriting.
    """
    zone = _colon_offset(default_tz)
    return let(strip(c), lambda s: F.coalesce(_iso(s, zone), let(
        _half_days(F.regexp_replace(s, _OTHER_ZONE, "")), lambda t: _iso(_rewritten(t), zone)))).try_cast("timestamp")


def _iso(s: Column, zone: str) -> Column:
    return let(F.regexp_replace(s, _NO_SECONDS, "$1:00"), lambda t: _canonical(t, zone))


def _half_days(s: Column) -> Column:
    """Clock times with AM or PM as hours of the day."""
    hour = F.regexp_extract(s, _HALF_DAY, 1).try_cast("int") % 12 + F.when(
        F.lower(F.regexp_extract(s, _HALF_DAY, 3)) == "p", 12).otherwise(0)
    parts = F.concat(F.regexp_extract(s, "^(.*?)" + _HALF_DAY, 1), F.lpad(hour.cast("string"), 2, "0"), F.lit(":"),
                     F.regexp_extract(s, _HALF_DAY, 2), F.regexp_extract(s, _HALF_DAY + "(.*)$", 4))
    return F.when(s.rlike(_HALF_DAY), parts).otherwise(s)


def _rewritten(s: Column) -> Column:
    """Texts with a month name, other number orders or no separators as year, month, day and the rest."""
    def dated(pattern: str, year: int, month: int, day: int, rest: Column) -> Column:
        number = F.array_position(F.array(*[F.lit(m) for m in _MONTHS]), F.lower(F.regexp_extract(s, pattern, month)))
        return let(number, lambda m: F.when(m > 0, F.concat(
            F.regexp_extract(s, pattern, year), F.lit("-"), m.cast("string"), F.lit("-"), F.regexp_extract(s, pattern, day), rest)))

    first, second = (F.regexp_extract(s, _NUMBERS, i).try_cast("int") for i in (1, 2))
    numbers = F.when(first > 12, F.regexp_replace(s, _NUMBERS, "$3-$2-$1")).otherwise(F.regexp_replace(s, _NUMBERS, "$3-$1-$2"))
    compact = F.when(F.regexp_extract(s, _COMPACT, 4) == "", F.regexp_replace(s, _COMPACT, "$1-$2-$3")).when(
        F.regexp_extract(s, _COMPACT, 6) == "", F.regexp_replace(s, _COMPACT, "$1-$2-$3 $4:$5")).otherwise(
        F.regexp_replace(s, _COMPACT, "$1-$2-$3 $4:$5:$6"))
    return (
        F.when(s.rlike(_DMONY), dated(_DMONY, 3, 2, 1, F.regexp_replace(s, _DMONY, "")))
        .when(s.rlike(_CTIME), dated(_CTIME, 4, 1, 2, F.concat(F.lit(" "), F.regexp_extract(s, _CTIME, 3))))
        .when(s.rlike(_MONDY), dated(_MONDY, 3, 1, 2, F.regexp_replace(s, _MONDY, "")))
        .when(s.rlike(_NUMBERS), numbers).when(s.rlike(_COMPACT), compact).otherwise(s))


def _canonical(s: Column, zone: str) -> Column:
    """One shape with an explicit zone; null for any other text, so sentinels too."""
    clock = "[T ]" + _CLOCK
    shapes = [
        (_YMD + clock + _UTC, "$1-$2-$3 $4+00:00"),
        (_YMD + clock + _OFFSET, "$1-$2-$3 $4$5:$6"),
        (_YMD + clock + _HOURS, "$1-$2-$3 $4$5:00"),
        (_YMD + clock + "$", "$1-$2-$3 $4" + zone),
        (_YMD + "$", "$1-$2-$3 00:00:00" + zone),
    ]
    return F.coalesce(*[F.when(s.rlike(p), F.regexp_replace(s, p, by)) for p, by in shapes])
