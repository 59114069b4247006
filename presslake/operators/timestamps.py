"""Timestamps of mixed form, precision and zone, brought to one UTC instant.

Every value is reduced to a *shape mask*: digits become ``9``, letters ``A``, the rest stays. A mask fixes the
position of every field, so it is mapped to a parser once (and cached), and all values of one mask are converted
together by numpy slices. Wall times go through zone transition tables that are built on the driver from the tz
database and shipped with the plan, so that every executor converts alike whatever its own database is; the version of
the database is a column of the result where the caller asks for it.

Defined results
    null, '', blank, over ``MAX_LENGTH`` code points when trimmed .. null (no known form is so long)
    no known mask, unknown month or zone word ............... null
    bare dates, words, impossible dates or times ............ null
    1970-01-01T00:00:00Z .................................... null (a default value, no time)
    time that occurs twice .................................. the first
    time skipped by a clock change .......................... moved forward by the gap
    unknown or null zone on a value without zone ............ null
    repeated rows, extra columns ............................ kept as they are
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta, timezone
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.session import ship

MAX_LENGTH = 120
FIRST_YEAR, LAST_YEAR = 1900, 2100

# Month names (az, ru nominative and genitive, tr, en and common abbreviations).
_MONTH_WORDS = {
    1: "yanvar январь января ocak january jan oca янв",
    2: "fevral февраль февраля şubat subat february feb фев",
    3: "mart март марта mart march mar мар",
    4: "aprel апрель апреля nisan april apr апр",
    5: "may май мая mayıs mayis may",
    6: "iyun июнь июня haziran june jun июн",
    7: "iyul июль июля temmuz july jul июл",
    8: "avqust август августа ağustos agustos august aug авг",
    9: "sentyabr сентябрь сентября eylül eylul september sep sept сен",
    10: "oktyabr октябрь октября ekim october oct окт",
    11: "noyabr ноябрь ноября kasım kasim november nov ноя",
    12: "dekabr декабрь декабря aralık aralik december dec дек",
}
_ZONE_WORDS = {"z": 0, "utc": 0, "gmt": 0}
_WEEKDAYS = "mon tue wed thu fri sat sun monday tuesday wednesday thursday friday saturday sunday".split()


def _fold(word: str) -> str:
    return word.replace("I", "ı").replace("İ", "i").lower().replace("ı", "i").replace("̇", "")


MONTHS = {_fold(w): m for m, words in _MONTH_WORDS.items() for w in words.split()}

# The grammar of masks. Named groups give the positions of the fields.
_TIME = r"(?P<h>99?):(?P<mi>99)(?::(?P<s>99)(?:[.,](?P<f>9{1,9}))?)?"
_AMPM = r"(?: ?(?P<ap>AA)(?!A)9*)?"
_ZONE = r"(?: ?(?P<zw>A{1,3})(?P<zs2>[+-])(?P<zh2>99):?(?P<zm2>99)?(?: ?\([A ]+\))?| ?(?P<zs>[+-])(?P<zh>99):?(?P<zm>99)?| ?(?P<zw1>A{1,3})| ?\((?P<zw3>A{3}) ?(?P<zs3>[+-])(?P<zh3>99):?(?P<zm3>99)?\))?"
_LABEL = r"(?:A+(?: A+)*: *)?"
_SEP = r"(?:(?P<t>A)| */ *|, *|\+| +)"
_WORDDAY = r"(?:(?P<wd>A{3,9}),? +)?"
_GRAMMAR = [
    rf"{_LABEL}(?P<Y>9999)(?P<q>[-./])(?P<M>99?)(?P=q)(?P<D>99?){_SEP}{_TIME}{_ZONE}",
    rf"{_LABEL}(?P<D>99?)(?P<q>[-.])(?P<M>99?)(?P=q)(?P<Y>9999){_SEP}{_TIME}{_AMPM}{_ZONE}",
    rf"{_LABEL}(?P<D>99?)(?P<q>[-.])(?P<M>99?)(?P=q)(?P<Y>9999) +\[{_TIME}\]",
    rf"{_LABEL}(?P<a>99?)/(?P<b>99?)/(?P<Y>9999),? +{_TIME}{_AMPM}{_ZONE}",
    rf"{_LABEL}{_WORDDAY}(?P<D>99?)[ .-]+(?P<mon>A+)[ .,-]+(?P<Y>9999){_SEP}{_TIME}{_AMPM}{_ZONE}",
    rf"{_LABEL}{_WORDDAY}(?P<mon>A+)[ .]+(?P<D>99?),? +(?P<Y>9999),? +{_TIME}{_AMPM}{_ZONE}",
    r"(?P<Y>9999)(?P<M>99)(?P<D>99)(?P<t>A)(?P<h>99)(?P<mi>99)(?P<s>99)?" + _ZONE,
    r"(?P<epoch>9{9,10})(?:\.9+)?",
    r"(?P<epoch_ms>9{13})",
    r"(?P<epoch_us>9{16})",
]
_PATTERNS = [re.compile(x) for x in _GRAMMAR]


@lru_cache(maxsize=4096)
def parser_of(mask: str) -> dict[str, tuple[int, int]] | None:
    """The field spans that a mask fixes; None if the mask belongs to no known form."""
    for p in _PATTERNS:
        if m := p.fullmatch(mask):
            return {k: m.span(k) for k, v in m.groupdict().items() if v is not None}
    return None


def zone_table(name: str) -> tuple[np.ndarray, np.ndarray]:
    """``(walls, offsets)``: offsets[i] holds for wall seconds in [walls[i-1], walls[i]).

    The limits are wall times at which the later offset takes over, such that a time that occurs twice is read with
    the offset before the change, and so is one that was skipped (which moves it forward by the gap).
    """
    if m := re.fullmatch(r"([+-])(\d\d):?(\d\d)?", name):
        off = (int(m[2]) * 3600 + int(m[3] or 0) * 60) * (-1 if m[1] == "-" else 1)
        return np.empty(0, np.int64), np.array([off], np.int64)
    from zoneinfo import ZoneInfo

    zone, epoch = ZoneInfo(name), datetime(1970, 1, 1, tzinfo=timezone.utc)
    offset = lambda t: int((epoch + timedelta(seconds=t)).astimezone(zone).utcoffset().total_seconds())
    lo = int((datetime(FIRST_YEAR, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds())
    hi = int((datetime(LAST_YEAR, 1, 1, tzinfo=timezone.utc) - epoch).total_seconds())
    walls, offsets, step = [], [offset(lo)], 3 * 86_400  # no zone has two changes within three days
    for t in range(lo, hi, step):
        if offset(t + step) != offsets[-1]:
            a, b = t, t + step
            while b - a > 1:
                c = (a + b) // 2
                a, b = (c, b) if offset(c) == offsets[-1] else (a, c)
            walls.append(b + max(offsets[-1], offset(b)))
            offsets.append(offset(b))
    return np.array(walls, np.int64), np.array(offsets, np.int64)


@lru_cache(maxsize=16)
def zone_tables(names: tuple[str, ...]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Tables by zone name; names that the tz database lacks are left out."""
    tables = {}
    for n in names:
        try:
            tables[n] = zone_table(n)
        except (KeyError, ValueError, OSError):
            pass
    return tables


def tz_version() -> str:
    """Version of the tz database the tables are built from: of the system's files where there are any, as zoneinfo prefers them."""
    import zoneinfo

    for folder in zoneinfo.TZPATH:
        for name in ("tzdata.zi", "+VERSION"):
            path = os.path.join(folder, name)
            if os.path.exists(path):
                with open(path, encoding="utf-8") as f:
                    return f.readline().replace("# version", "").strip()
        if os.path.exists(os.path.join(folder, "UTC")):
            return f"system {folder}"
    import tzdata

    return tzdata.IANA_VERSION


def _days(y: np.ndarray, m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970-01-01, and whether the date exists."""
    ok = (m >= 1) & (m <= 12) & (y >= 1)
    ym = (y - 1970) * 12 + np.where(ok, m, 1) - 1
    first = ym.astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)
    after = (ym + 1).astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)
    return first + d - 1, ok & (d >= 1) & (d <= after - first)


class _Cells:
    """Equally long strings as a matrix of code points, with readers of digit and word fields."""

    def __init__(self, values: np.ndarray, n: int):
        self.rows = np.ascontiguousarray(values.astype(f"<U{n}")).view(np.uint32).reshape(len(values), n)

    def number(self, span: tuple[int, int]) -> np.ndarray:
        out = np.zeros(len(self.rows), np.int64)
        for k in range(*span):
            out = out * 10 + (self.rows[:, k].astype(np.int64) - 48)
        return out

    def word(self, span: tuple[int, int], known: dict[str, int]) -> np.ndarray:
        """The value of each word, -1 if unknown."""
        part = np.ascontiguousarray(self.rows[:, slice(*span)]).view(f"<U{span[1] - span[0]}").ravel()
        words, where = np.unique(part, return_inverse=True)
        return np.array([known.get(_fold(w), -1) for w in words], np.int64)[where]

    def sign(self, span: tuple[int, int]) -> np.ndarray:
        return np.where(self.rows[:, span[0]] == 45, -1, 1)


def _convert(mask: str, values: np.ndarray, zones: np.ndarray, month_first: np.ndarray, tables: dict) -> np.ndarray:
    """UTC microseconds as float-safe int64; the lowest int64 marks no case."""
    none = np.iinfo(np.int64).min
    out = np.full(len(values), none, np.int64)
    at = parser_of(mask)
    if at is None:
        return out
    c = _Cells(values, len(mask))
    for key, unit in (("epoch", 1_000_000), ("epoch_ms", 1000), ("epoch_us", 1)):
        if key in at:
            return c.number(at[key]) * unit
    ok = np.ones(len(values), bool)
    year = c.number(at["Y"])
    if "a" in at:
        a, b = c.number(at["a"]), c.number(at["b"])
        mf = np.where(a > 12, False, np.where(b > 12, True, month_first))
        day, month = np.where(mf, b, a), np.where(mf, a, b)
    else:
        day = c.number(at["D"])
        month = c.word(at["mon"], MONTHS) if "mon" in at else c.number(at["M"])
    if "wd" in at:
        ok &= c.word(at["wd"], dict.fromkeys(_WEEKDAYS, 1)) == 1
    if "t" in at:
        ok &= c.word(at["t"], {"t": 1}) == 1
    hour, minute = c.number(at["h"]), c.number(at["mi"])
    second = c.number(at["s"]) if "s" in at else np.zeros_like(hour)
    micro = c.number((at["f"][0], min(at["f"][1], at["f"][0] + 6))) * 10 ** max(0, 6 - (at["f"][1] - at["f"][0])) if "f" in at else 0
    zone_word, ampm = next((at[k] for k in ("zw", "zw1", "zw3") if k in at), None), at.get("ap")
    if zone_word is not None and ampm is None and zone_word[1] - zone_word[0] == 2:
        ampm, zone_word = zone_word, None
    if ampm is not None:
        half = c.word(ampm, {"am": 0, "pm": 12})
        ok &= (half >= 0) & (hour >= 1) & (hour <= 12)
        hour = hour % 12 + half
    ok &= (hour <= 23) & (minute <= 59) & (second <= 59)
    days, exists = _days(year, month, day)
    ok &= exists
    wall = days * 86_400 + hour * 3600 + minute * 60 + second
    zoned = False
    if zone_word is not None:
        ok &= c.word(zone_word, _ZONE_WORDS) == 0
        utc, zoned = wall, True
    for k in ("", "2", "3"):
        if f"zs{k}" in at:
            zh = c.number(at[f"zh{k}"])
            zm = c.number(at[f"zm{k}"]) if f"zm{k}" in at else np.zeros_like(zh)
            ok &= (zh <= 18) & (zm <= 59)
            utc, zoned = wall - c.sign(at[f"zs{k}"]) * (zh * 3600 + zm * 60), True
    if not zoned:
        utc = wall.copy()
        names, where = np.unique(zones, return_inverse=True)
        for i, name in enumerate(names):
            mine = where == i
            if name in tables:
                walls, offsets = tables[name]
                utc[mine] = wall[mine] - offsets[np.searchsorted(walls, wall[mine], side="right")]
            else:
                ok &= ~mine
    return np.where(ok, utc * 1_000_000 + micro, none)


def _batch(raw: pd.Series, mask: pd.Series, zone: pd.Series, month_first: pd.Series, tables: dict) -> pd.Series:
    none = np.iinfo(np.int64).min
    out = np.full(len(raw), none, np.int64)
    codes, masks = pd.factorize(mask)
    order = np.argsort(codes, kind="stable")
    ends = np.searchsorted(codes[order], np.arange(len(masks) + 1))
    values = raw.fillna("").to_numpy(dtype=object)
    zones, mf = zone.fillna("").to_numpy(dtype=str), month_first.fillna(False).to_numpy(dtype=bool)
    for i, m in enumerate(masks):
        rows = order[ends[i] : ends[i + 1]]
        out[rows] = _convert(m, values[rows], zones[rows], mf[rows], tables)
    result = pd.Series(out).astype("Int64")
    result[(out == none) | (out == 0)] = pd.NA
    return result


def shape_mask(value: Column) -> Column:
    """Digits as 9, letters as A, everything else as it stands (JVM side)."""
    return F.regexp_replace(F.regexp_replace(value, r"[0-9]", "9"), r"\p{L}", "A")


def normalize_timestamps(df: DataFrame, value: str, zone: Column, month_first: Column, zones: Iterable[str], out: str = "utc_us", version: str | None = None) -> DataFrame:
    """Add ``out``: UTC microseconds since 1970 (bigint), or null; see the module for defined results.

    ``zone`` names the zone of values without one, ``zones`` all names that may occur (a small reference set);
    ``month_first`` decides dates written with slashes that leave the order open. ``version`` names a column for the version
    of the zone tables that were used.
    """
    ship(df.sparkSession)
    tables = zone_tables(tuple(sorted(set(zones))))

    def convert(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for raw, mask, z, mf in batches:
            yield _batch(raw, mask, z, mf, tables)

    # The hints of an iterator UDF, given as values because annotations of this module are strings.
    convert.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(convert, "bigint").asNondeterministic()  # else a filter on the result evaluates it again
    clean = F.regexp_replace(F.col(value), r"^[\s ]+|[\s ]+$", "")
    clean = F.when((F.length(clean) <= MAX_LENGTH) & (clean != ""), clean)
    clean = F.regexp_replace(clean, r"[\s ]", " ")
    done = df.withColumn(out, udf(clean, shape_mask(clean), zone.cast("string"), month_first))
    return done.withColumn(version, F.lit(tz_version())) if version else done


def utc_text(us: Column) -> Column:
    """``2025-03-01T08:15:00Z`` of UTC microseconds, whatever the session's zone; fractions are dropped."""
    s = F.floor(us / 1_000_000).cast("bigint")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s / 86_400).cast("int"))
    rest = F.pmod(s, F.lit(86_400))
    two = lambda x: F.lpad(x.cast("int").cast("string"), 2, "0")
    return F.concat(day.cast("string"), F.lit("T"), two(F.floor(rest / 3600)), F.lit(":"), two(F.floor(rest % 3600 / 60)), F.lit(":"), two(rest % 60), F.lit("Z"))
