"""String, hash and id expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space of Unicode, written out because Java's \s knows only ASCII.
WS = "[\\t-\\r \\u001c-\\u001f\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"


def normalize_space(x: Column) -> Column:
    """Runs of any white space as one space, ends trimmed; null stays null."""
    return F.trim(F.regexp_replace(x, WS, " "))


def normalize_whitespace(x: Column) -> Column:
    """Like ``normalize_space``, null as ''."""
    return F.coalesce(normalize_space(x), F.lit(""))


def first_non_empty(*values: Column) -> Column:
    """The first value that isn't blank, normalized; '' if there is none."""
    return F.coalesce(*[F.nullif(normalize_space(v), F.lit("")) for v in values], F.lit(""))


def summarize_text(x: Column, limit: int = 280) -> Column:
    """At most ``limit`` characters; longer texts end in three dots."""
    t = normalize_whitespace(x)
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.rtrim(F.left(t, F.lit(limit - 3))), F.lit("...")))


def fix_utf8_mojibake(x: Column) -> Column:
    """UTF-8 that was read as latin-1, read again; anything else unchanged."""
    narrow = x.rlike("^[\\u0000-\\u00ff]*$")
    again = F.try_validate_utf8(F.decode(F.encode(F.when(narrow, x), "ISO-8859-1"), "UTF-8"))
    return F.when(narrow & again.isNotNull() & ~F.coalesce(again.contains("�"), F.lit(True)), again).otherwise(x)


def published_date_raw(x: Column) -> Column:
    """What stands after the first ``Tarix:``, else everything; normalized."""
    return normalize_space(F.when(x.contains("Tarix:"), F.substr(x, F.locate("Tarix:", x) + 6)).otherwise(x))


def unique_in_order(a: Column) -> Column:
    """Values that aren't null or '', each at its first place."""
    return F.array_distinct(F.filter(a, lambda v: v.isNotNull() & (v != "")))


def clean_teaser(x: Column) -> Column:
    return F.btrim(F.replace(normalize_space(x), F.lit("davamı"), F.lit("")), F.lit(" ."))


def title_from_content(x: Column, words: int = 18) -> Column:
    """The first words of the first line."""
    return F.concat_ws(" ", F.slice(F.split(normalize_space(F.substring_index(x, "\n", 1)), " "), 1, words))


def media_body(text: Column, media: Column) -> Column:
    """The text of a message, or a note about its media type where it has no text."""
    t, m = normalize_whitespace(text), normalize_whitespace(media)
    return F.when((t == "") & (m != ""), F.concat(F.lit("[telegram media post without caption] "), m)).otherwise(t)


def message_title(title: Column, text: Column, media: Column) -> Column:
    """Title, else the first sentence, else the first 160 characters, else a note about the media type."""
    t, m = normalize_whitespace(text), normalize_whitespace(media)
    note = F.when((t == "") & (m != ""), F.concat(F.lit("[telegram media post] "), m))
    return first_non_empty(title, F.substring_index(t, ". ", 1), F.left(t, F.lit(160)), note)


def contains_folded(x: Column, part: str) -> Column:
    return F.lower(F.coalesce(x, F.lit(""))).contains(part.lower())


def safe_int(x: Column) -> Column:
    return F.trim(x).try_cast("bigint")


def primary_category(a: Column, noise: list[str], fallback: Column, canonical: str = "", home: list[str] = []) -> Column:  # noqa: B006
    """The first category (``fallback`` is the last) that isn't noise; else ``canonical`` if that is among them, else the first that isn't home, else ''."""
    listed = unique_in_order(F.transform(F.concat(a, F.array(fallback)), normalize_whitespace))
    first = lambda keep: F.try_element_at(F.filter(listed, keep), F.lit(1))
    wanted = first(lambda c: ~F.lower(c).isin([n.lower() for n in noise]))
    named = F.when(F.exists(listed, lambda c: F.lower(c) == canonical.lower()), canonical) if canonical else F.lit(None)
    return F.coalesce(wanted, named, first(lambda c: ~F.lower(c).isin([n.lower() for n in home])), F.lit(""))


def kept_paragraphs(a: Column, starts: list[str], contains: list[str], equals: list[str]) -> Column:
    """Paragraphs without those that begin with, hold, or are one of the given texts."""
    bad = lambda p: F.lit(False)
    tests = [*[(lambda p, t=t: p.startswith(t)) for t in starts], *[(lambda p, t=t: p.contains(t)) for t in contains], *[(lambda p, t=t: p == t) for t in equals]]
    for t in tests:
        bad = lambda p, b=bad, t=t: b(p) | t(p)
    return F.filter(a, lambda p: ~bad(p))


def safe_name(x: Column) -> Column:
    return F.translate(x, "/:", "__")


def sha256_text(x: Column) -> Column:
    return F.sha2(F.coalesce(x, F.lit("")), 256)


def stable_bigint(x: Column) -> Column:
    """The first eight bytes of the digest as a positive bigint; 0 becomes 1."""
    high = F.conv(F.substring(sha256_text(x), 1, 16), 16, 10).cast("decimal(20,0)")
    n = (high % F.lit("9223372036854775808").cast("decimal(20,0)")).cast("bigint")
    return F.when(n == 0, F.lit(1)).otherwise(n)


def message_hash(title: Column, body: Column) -> Column:
    return sha256_text(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(body, F.lit(""))))


def dedupe_key(canonical_url: Column, content_hash: Column, title: Column, published: Column) -> Column:
    """``url:`` of a canonical address, else ``hash:``, else ``sim:`` of the normalized title in lower case and the day of publication."""
    has = lambda c: c.isNotNull() & (c != "")
    similar = F.concat(F.lit("sim:"), sha256_text(F.concat(F.lower(normalize_whitespace(title)), F.lit("|"), F.coalesce(published.cast("date").cast("string"), F.lit("")))))
    return F.when(has(canonical_url), F.concat(F.lit("url:"), canonical_url)).when(has(content_hash), F.concat(F.lit("hash:"), content_hash)).otherwise(similar)


def record_uuid(*key: Column) -> Column:
    """A stable id of a key, in the form of a UUID."""
    h = F.sha2(F.concat_ws("|", *key), 256)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
