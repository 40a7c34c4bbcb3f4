"""Date text as JavaScript's Date reads it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .jscompat import col_of, let

# The names that a date text may hold, and the zones' hours.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
ZONES = {"z": 0, "ut": 0, "utc": 0, "gmt": 0, "est": -5, "edt": -4, "cst": -6, "cdt": -5, "mst": -7, "mdt": -6, "pst": -8, "pdt": -7}

_MONTH = rf"\b({'|'.join(MONTHS)})[a-z]*\.?"
_TIME = r"(?<![+\-\d:])(\d{1,2}):(\d{1,2})(?::(\d{1,2})(?:\.(\d+))?)?(?:\s*([ap])m\b)?"
_ZONE = rf"(?:(?<![a-z])({'|'.join(sorted(ZONES, key=len, reverse=True))})\b)"
_OFFSET = r"([+-])(\d{1,2}):?(\d{2})?\s*$"
_NO_SECONDS = r"^([^T ]+[T ]\d{2}:\d{2})(Z|[+-]\d{2}:?\d{2})$"
_YEAR = 2001  # of a text without one


def js_timestamp(c) -> Column:
    """Instant of a date text; NULL where it cannot be read.

    ISO forms are read as Spark casts them, but a date without a time is UTC, as in
    JavaScript, not the session's zone.  Other texts are read by their parts, in any order and
    case: a month's name (its first three letters count), numbers for day, month and year
    (``3/1/2026`` is month, day, year; ``2026/3/1`` year, month, day; years below 50 are in
    this century, below 100 in the last, a missing one is 2001), a time with or without
    seconds, fractions and am or pm, a zone by name or offset.  Words before the first number
    and text in parentheses are skipped, an unknown word behind a number makes the text
    unreadable.  Days beyond the month's end run into the next one.  Without a zone a text is
    in the session's.
    """
    # every step is worked out once: a text used twice in an expression is otherwise built twice
    iso = lambda x: F.when(x.rlike(r"^[+-]?\d{4,6}(?:-|$)"), _iso(x))
    parts = lambda x: let(F.lower(F.regexp_replace(x, r"\([^()]*\)", " ")), _by_parts)
    return let(F.nullif(F.btrim(col_of(c)), F.lit("")), lambda x: F.coalesce(iso(x), parts(x)))


def _iso(x: Column) -> Column:
    day_only = x.rlike(r"^\d{4}(?:-\d{2}){0,2}$")
    day = F.concat(x, F.when(F.length(x) == 4, "-01-01").when(F.length(x) == 7, "-01").otherwise(""), F.lit("T00:00:00Z"))
    return F.when(day_only, day).otherwise(F.regexp_replace(x, _NO_SECONDS, "$1:00$2")).try_cast("timestamp")


def _part(text: Column, pattern: str, group: int) -> Column:
    return let(F.regexp_extract(text, pattern, group), lambda m: F.nullif(m, F.lit("")))


def _taken(text: Column, pattern: str, body, when: Column | None = None) -> Column:
    """``body`` over the first match of the pattern (null: none, or not ``when``) and the text
    with all its matches blanked."""
    found = _part(text, pattern, 0)
    found = found if when is None else F.when(when, found)
    return let(found, lambda m: let(F.when(m.isNull(), text).otherwise(F.regexp_replace(text, pattern, " ")), lambda rest: body(m, rest)))


def _by_parts(x: Column) -> Column:
    zones = F.create_map(*(F.lit(v) for kv in ZONES.items() for v in kv))
    months = F.array(*map(F.lit, MONTHS))

    def shift(offset: Column, zone: Column) -> Column:
        """Minutes east of UTC."""
        given = F.when(_part(offset, _OFFSET, 1) == "-", -1).otherwise(1) * (
            _part(offset, _OFFSET, 2).try_cast("int") * 60 + F.coalesce(_part(offset, _OFFSET, 3).try_cast("int"), F.lit(0)))
        return F.coalesce(F.when(offset.isNotNull(), given), zones[zone] * 60)

    # the time, the zone, the offset behind a time and the month's name, each taken out of the rest
    return _taken(x, _TIME, lambda time, rest: _taken(rest, _ZONE, lambda zone, rest: _taken(rest, _OFFSET, lambda offset, rest: _taken(
        rest, _MONTH, lambda name, rest: _instant(
            _day(rest, F.array_position(months, F.substring(name, 1, 3)).cast("int")), time, shift(offset, zone))), time.isNotNull())))


def _day(rest: Column, month: Column) -> Column:
    """The date of a text's numbers and its month by name (null: none)."""
    numbers = F.transform(F.regexp_extract_all(rest, F.lit(r"(\d+)"), F.lit(1)), lambda n: n.try_cast("int"))
    unknown = rest.rlike(r"\d.*[a-z]")

    def composed(n: Column) -> Column:
        a, b, c = (F.get(n, k) for k in range(3))
        day_first = a.between(1, 31)
        size = F.size(n)
        y = F.when(month.isNotNull(), F.when(size == 1, _YEAR).when(day_first, b).otherwise(a)).when(size == 2, _YEAR).when(day_first, c).otherwise(a)
        m = F.when(month.isNotNull(), month).when((size == 2) | day_first, a).otherwise(b)
        d = F.when(month.isNotNull(), F.when((size == 1) | day_first, a).otherwise(b)).when((size == 2) | day_first, b).otherwise(c)
        whole = F.when(month.isNotNull(), size.between(1, 2)).otherwise(size.between(2, 3))
        return F.when(whole, let(F.struct(y.alias("y"), m.alias("m"), d.alias("d")), dated))

    def dated(p: Column) -> Column:
        y, m, d = p["y"], p["m"], p["d"]
        year = F.when(y.between(0, 49), y + 2000).when(y.between(50, 99), y + 1900).otherwise(y)
        ok = m.between(1, 12) & d.between(1, 31) & y.between(0, 9999)
        return F.when(ok, F.date_add(F.make_date(year, m, F.lit(1)), d - 1))

    return F.when(~unknown, let(numbers, composed))


def _instant(day: Column, time: Column, shift: Column) -> Column:
    hour, minute, second = (F.coalesce(_part(time, _TIME, k).try_cast("int"), F.lit(0)).alias(c) for k, c in ((1, "hour"), (2, "minute"), (3, "second")))
    parts = F.struct(day.alias("day"), hour, minute, second, _part(time, _TIME, 4).alias("fraction"), _part(time, _TIME, 5).alias("half"), shift.alias("shift"))

    def of(p: Column) -> Column:
        hour = F.when(p["half"].isNull(), p["hour"]).when(p["hour"] <= 12, p["hour"] % 12 + F.when(p["half"] == "p", 12).otherwise(0))
        right = hour.between(0, 23) & p["minute"].between(0, 59) & p["second"].between(0, 59)
        fraction = F.substring(F.concat(F.coalesce(p["fraction"], F.lit("")), F.lit("000")), 1, 3)
        text = F.concat(p["day"].cast("string"), F.format_string(" %02d:%02d:%02d.%s", hour, p["minute"], p["second"], fraction))
        east = p["shift"]
        zone = F.when(east.isNull(), "").otherwise(F.concat(F.when(east < 0, "-").otherwise("+"), F.format_string("%02d:%02d", F.floor(F.abs(east) / 60), F.abs(east) % 60)))
        return F.when(right & p["day"].isNotNull(), F.concat(text, zone).try_cast("timestamp"))

    return let(parts, of)
