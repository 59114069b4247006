"""Date and time expressions: text in, ISO 8601 text out ('' if unparsable). Wall times are at the fixed offset +04:00."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.text import normalize_whitespace

OFFSET = "+04:00"
# Names of the months; August is written in two ways.
AUGUST = "avgust"
AZ_MONTHS = ["yanvar", "fevral", "mart", "aprel", "may", "iyun", "iyul", "avqust", "sentyabr", "oktyabr", "noyabr", "dekabr"]
EN_MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def _month(name: Column, names: list[str]) -> Column:
    listed = [*enumerate(names, 1), *([(8, AUGUST)] if names is AZ_MONTHS else [])]
    return F.create_map(*[F.lit(x) for i, n in listed for x in (n, f"{i:02d}")])[F.lower(F.translate(name, "İI", "iı" if names is AZ_MONTHS else "ii"))]


def _date(y: Column, m: Column, d: Column) -> Column:
    """yyyy-MM-dd, null if there is no such day."""
    text = F.concat_ws("-", F.lpad(y, 4, "0"), F.lpad(m, 2, "0"), F.lpad(d, 2, "0"))
    return F.when(m.isNotNull() & (y != "") & (d != ""), F.try_to_date(text, "yyyy-MM-dd")).cast("string")


def _part(x: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(x, pattern, group)


def _clock(h: Column, m: Column, s: Column) -> Column:
    """HH:mm:ss, null if out of range."""
    sec = F.when(s == "", "00").otherwise(s)
    ok = (h != "") & (h.try_cast("int") <= 23) & (m.try_cast("int") <= 59) & (sec.try_cast("int") <= 59)
    return F.when(ok, F.concat_ws(":", F.lpad(h, 2, "0"), m, sec))


def azerbaijani_date(x: Column, year: Column) -> Column:
    """``07 aprel 2026``; ``year`` stands in where the text has none."""
    p = r"(?i)(\d{1,2})\s+([a-zçəğıiöşü]+)(?:\s+(\d{4}))?"
    y = F.when(_part(x, p, 3) == "", year.cast("string")).otherwise(_part(x, p, 3))
    return F.coalesce(_date(y, _month(_part(x, p, 2), AZ_MONTHS), _part(x, p, 1)), F.lit(""))


def azerbaijani_datetime(date: Column, time: Column, year: Column) -> Column:
    """Date and ``H:MM[:SS]``; only the date where the time is missing or wrong."""
    d, p = azerbaijani_date(date, year), r"(\d{1,2}):(\d{2})(?::(\d{2}))?"
    t = _clock(_part(time, p, 1), _part(time, p, 2), _part(time, p, 3))
    return F.when((d != "") & t.isNotNull(), F.concat(d, F.lit("T"), t, F.lit(OFFSET))).otherwise(d)


def rfc2822(x: Column) -> Column:
    """``Mon, 09 Jun 2025 18:13:12 +0000`` with its own offset."""
    p = r"(\d{1,2}) ([A-Za-z]{3})[a-z]* (\d{4}) (\d{2}):(\d{2})(?::(\d{2}))? (?:([+-]\d{2}):?(\d{2})|GMT|UTC|Z)"
    d = _date(_part(x, p, 3), _month(_part(x, p, 2), EN_MONTHS), _part(x, p, 1))
    off = F.when(_part(x, p, 7) == "", "+00:00").otherwise(F.concat(_part(x, p, 7), F.lit(":"), _part(x, p, 8)))
    return F.coalesce(F.concat(d, F.lit("T"), _clock(_part(x, p, 4), _part(x, p, 5), _part(x, p, 6)), off), F.lit(""))


def _numeric(x: Column, p: str, y: int, m: int, d: int, h: int) -> Column:
    date = _date(_part(x, p, y), _part(x, p, m), _part(x, p, d))
    return F.concat(date, F.lit("T"), _clock(_part(x, p, h), _part(x, p, h + 1), _part(x, p, h + 2)), F.lit(OFFSET))


def azertag_datetime(x: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; other texts come back cleaned."""
    t = normalize_whitespace(x)
    return F.coalesce(_numeric(t, r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$", 1, 2, 3, 4), t)


def axar_datetime(x: Column) -> Column:
    """``yyyy.MM.dd / HH:mm``; other texts come back cleaned."""
    t = normalize_whitespace(x)
    return F.coalesce(_numeric(t, r"^(\d{4})\.(\d{2})\.(\d{2}) / (\d{2}):(\d{2})()$", 1, 2, 3, 4), t)


def xeberler_datetime(x: Column) -> Column:
    """``dd-MM-yyyy / HH:mm``, ``dd-MM-yyyy`` or ``yyyy-MM-dd+HH:mm:ss±hhmm``."""
    t = normalize_whitespace(x)
    z = r"^(\d{4})-(\d{2})-(\d{2})\+(\d{2}):(\d{2}):(\d{2})([+-]\d{2})(\d{2})$"
    own = F.concat(_date(_part(t, z, 1), _part(t, z, 2), _part(t, z, 3)), F.lit("T"), _clock(_part(t, z, 4), _part(t, z, 5), _part(t, z, 6)), _part(t, z, 7), F.lit(":"), _part(t, z, 8))
    d = r"^(\d{2})-(\d{2})-(\d{4})$"
    return F.coalesce(_numeric(t, r"^(\d{2})-(\d{2})-(\d{4}) / (\d{2}):(\d{2})()$", 3, 2, 1, 4), _date(_part(t, d, 3), _part(t, d, 2), _part(t, d, 1)), own, F.lit(""))


def islamazeri_datetime(x: Column) -> Column:
    """``M/d/yyyy h:mm:ss AM|PM`` anywhere in the text."""
    p = r"(?i)(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2}):(\d{2})\s*(AM|PM)"
    h = _part(x, p, 4).try_cast("int")
    hour = F.when((h < 1) | (h > 12), None).otherwise(h % 12 + F.when(F.upper(_part(x, p, 7)) == "PM", 12).otherwise(0)).cast("string")
    date = _date(_part(x, p, 3), _part(x, p, 1), _part(x, p, 2))
    return F.coalesce(F.concat(date, F.lit("T"), _clock(hour, _part(x, p, 5), _part(x, p, 6)), F.lit(OFFSET)), F.lit(""))


def iso_or_dotted_date(x: Column) -> Column:
    t, i, d = normalize_whitespace(x), r"^(\d{4})-(\d{2})-(\d{2})$", r"^(\d{2})\.(\d{2})\.(\d{4})$"
    return F.coalesce(_date(_part(t, i, 1), _part(t, i, 2), _part(t, i, 3)), _date(_part(t, d, 3), _part(t, d, 2), _part(t, d, 1)), F.lit(""))


def iso_with_offset(x: Column) -> Column:
    """An ISO time, at +04:00 if it names no offset; ``Z`` as +00:00."""
    t, p = normalize_whitespace(x), r"^(\d{4})-(\d{2})-(\d{2})[T ](\d{2}):(\d{2})(?::(\d{2})(?:\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?$"
    z = _part(t, p, 7)
    off = F.when(z == "", OFFSET).when(z == "Z", "+00:00").otherwise(F.concat(F.left(z, F.lit(3)), F.lit(":"), F.right(z, F.lit(2))))
    return F.coalesce(F.concat(_date(_part(t, p, 1), _part(t, p, 2), _part(t, p, 3)), F.lit("T"), _clock(_part(t, p, 4), _part(t, p, 5), _part(t, p, 6)), off), F.lit(""))


def apa_datetime(x: Column, year: Column) -> Column:
    """``08 aprel 2026 12:04 (UTC +04:00)``."""
    t = F.trim(F.regexp_replace(normalize_whitespace(x), r"\s*\(UTC \+04:00\)", ""))
    return azerbaijani_datetime(t, F.regexp_extract(t, r"(\d{1,2}:\d{2}(?::\d{2})?)$", 1), year)


def js_datetime(x: Column) -> Column:
    """``Wed Apr 22 2026 15:01:00 GMT+0400 (...)`` with its own offset."""
    p = r"^[A-Za-z]{3} ([A-Za-z]{3}) (\d{2}) (\d{4}) (\d{2}):(\d{2}):(\d{2}) GMT([+-]\d{2})(\d{2})"
    t = normalize_whitespace(x)
    d = _date(_part(t, p, 3), _month(_part(t, p, 1), EN_MONTHS), _part(t, p, 2))
    return F.coalesce(F.concat(d, F.lit("T"), _clock(_part(t, p, 4), _part(t, p, 5), _part(t, p, 6)), _part(t, p, 7), F.lit(":"), _part(t, p, 8)), F.lit(""))


def iqtisadiyyat_datetime(x: Column) -> Column:
    """ISO, else the form of scripts, else that of mail headers."""
    return F.coalesce(F.nullif(iso_with_offset(x), F.lit("")), F.nullif(js_datetime(x), F.lit("")), rfc2822(x))


def yeniazerbaycan_datetime(x: Column) -> Column:
    """Brackets as spaces; ISO first (a bare date is its midnight), then ``dd.MM.yyyy HH:mm``, then ``dd.MM.yyyy``."""
    t = normalize_whitespace(F.translate(x, "[]", "  "))
    midnight = F.concat(F.nullif(iso_or_dotted_date(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), t)), F.lit("")), F.lit("T00:00:00"), F.lit(OFFSET))
    return F.coalesce(F.nullif(iso_with_offset(t), F.lit("")), midnight, _numeric(t, r"^(\d{2})\.(\d{2})\.(\d{4}) (\d{2}):(\d{2})()$", 3, 2, 1, 4), iso_or_dotted_date(t))


def visible_datetime(x: Column, year: Column) -> Column:
    """The last word as time, the rest as date; else the date; else the text."""
    t = normalize_whitespace(x)
    whole = azerbaijani_datetime(F.regexp_replace(t, r"\s+\S+$", ""), F.regexp_extract(t, r"(\S+)$", 1), year)
    return F.coalesce(F.nullif(whole, F.lit("")), F.nullif(azerbaijani_date(t, year), F.lit("")), t)


def schema_datetime(x: Column) -> Column:
    """``dd.MM.yyyy HH:mm:ss`` or ``yyyy-MM-dd HH:mm:ss`` at +04:00, else an ISO time with its own offset."""
    t = normalize_whitespace(x)
    return F.coalesce(_numeric(t, r"^(\d{2})\.(\d{2})\.(\d{4}) (\d{2}):(\d{2}):(\d{2})$", 3, 2, 1, 4), _numeric(t, r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})$", 1, 2, 3, 4), iso_with_offset(t))


def feed_datetime(x: Column) -> Column:
    """An ISO time converted to +04:00; what can't be read comes back as it is."""
    return F.coalesce(F.nullif(at_fixed_offset(x), F.lit("")), x, F.lit(""))


def card_datetime(date: Column, time: Column, year: Column) -> Column:
    """Date and time of a listing card from its two parts, or from the first alone where the second is missing."""
    both = normalize_whitespace(time) != ""
    return F.when(both, azerbaijani_datetime(date, time, year)).otherwise(apa_datetime(date, year))


def first_instant(candidates: list[Column], fallback: Column) -> Column:
    """The first of several texts that is an ISO time or date, as a timestamp; else ``fallback`` (the time of the run)."""
    ok = lambda c: F.when(F.trim(c).rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"), F.try_to_timestamp(F.regexp_replace(F.trim(c), r"([+-]\d{2})(\d{2})$", "$1:$2")))
    return F.coalesce(*[ok(c) for c in candidates], fallback)


def heartbeat(x: Column) -> Column:
    """The time of a heartbeat; 1970 if it can't be read."""
    return F.coalesce(F.try_to_timestamp(F.when(F.trim(x) != "", F.trim(x))), F.lit("1970-01-01 00:00:00").cast("timestamp"))


def at_fixed_offset(x: Column) -> Column:
    """An ISO time converted to +04:00; '' if it names no offset or can't be read. Independent of the session's zone."""
    t = normalize_whitespace(x)
    ok = t.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$")
    s = F.unix_seconds(F.try_to_timestamp(F.when(ok, F.regexp_replace(t, r"([+-]\d{2})(\d{2})$", "$1:$2")))) + 4 * 3600
    day, rest = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s / 86_400).cast("int")).cast("string"), F.pmod(s, F.lit(86_400))
    two = lambda v: F.lpad(v.cast("int").cast("string"), 2, "0")
    return F.coalesce(F.concat(day, F.lit("T"), two(F.floor(rest / 3600)), F.lit(":"), two(F.floor(rest % 3600 / 60)), F.lit(":"), two(rest % 60), F.lit(OFFSET)), F.lit(""))
