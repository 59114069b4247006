"""Address expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.text import normalize_whitespace

_URL = r"^([A-Za-z][A-Za-z0-9+.-]*:)//([^/?#]*)([^?#]*)"
IMAGE = r"\.(jpg|jpeg|png|webp|gif|bmp)$"
TRACKING = r"(?i)^(utm_|fbclid|gclid)"

# Shapes of article paths by portal, as (id, slug, category) patterns; an id group is digits.
PATH_PATTERNS: dict[str, tuple[str | None, str | None, str | None]] = {
    "sonxeber.az": (r"^/(\d{6})(?:/[^/?#]+)?/?$", r"^/\d{6}/([^/?#]+)/?$", None),
    "oxu.az": (r"/(\d{4,})/?$", None, None),
    "metbuat.az": (r"^/news/(\d+)(?:/[^/?#]+?(?:\.html)?)?/?$", r"^/news/\d+/([^/?#]+?)(?:\.html)?/?$", None),
    "report.az": (r"(?:^|/)(\d{4,})/?$", None, None),
    "azertag.az": (r"^/az/xeber/(\d+)/?$", None, None),
    "yenixeber.az": (r"^/[^/?#]+-(\d+)/?$", r"^/([^/?#]+)-\d+/?$", None),
    "teleqraf.az": (r"^/news/[^/?#]+/(\d+)\.html/?$", None, r"^/news/([^/?#]+)/\d+\.html/?$"),
    "axar.az": (r"^/news/[^/?#]+/(\d+)\.html/?$", None, r"^/news/([^/?#]+)/\d+\.html/?$"),
    "milli.az": (r"^/(?!tag/)[^/?#]+/(\d+)\.html/?$", None, r"^/(?!tag/)([^/?#]+)/\d+\.html/?$"),
    "azerbaijan.az": (r"^/news/(\d+)/?$", None, None),
    "ikisahil.az": (r"^/post/(\d{5,})-(?!share/?$)[^/?#]+?/?$", r"^/post/(?!\d{5,}-share/?$)(?:\d{5,}-)?([^/?#]+?)/?$", None),
    "azxeber.com": (None, r"^/az/([^/?#]+)/[^/?#]+/?$", r"^/az/[^/?#]+/([^/?#]+)/?$"),
    "apa.az": (r"^/[^/?#]+/(?:[^/?#]+-)?(-?\d+)/?$", r"^/[^/?#]+/([^/?#]+)--?\d+/?$", r"^/([^/?#]+)/(?:[^/?#]+-)?-?\d+/?$"),
    "xeberler.az": (r"^/new/details/[^/?#]+?--(\d+)\.htm/?$", r"^/new/details/([^/?#]+?)--\d+\.htm/?$", None),
    "siyasetinfo.az": (r"^/(\d{3,})/?$", None, None),
    "yeniazerbaycan.com": (r"^/[^/_?#]+_e(\d+)_az\.html/?$", None, r"^/([^/_?#]+)_e\d+_az\.html/?$"),
    "islam.az": (r"^/(\d{4,})/[^/?#]+/?$", r"^/\d{4,}/([^/?#]+)/?$", None),
    "islamazeri.com": (r"(?i)^/image/haber(?:/\d+x\d+)?/[^/?#]*-(\d+)\.(?:jpe?g|png|webp)$", r"^/([^/?#]+?)\.html/?$", None),
    "sia.az": (r"^/az/news/[^/?#]+/(\d+)\.html/?$", None, r"^/az/news/([^/?#]+)/\d+\.html/?$"),
    "1news.az": (r"^/az/news/(\d{17})(?:-[^/?#]+)?/?$", r"^/az/news/\d{17}-([^/?#]+)/?$", None),
    "iqtisadiyyat.az": (r"^/az/post/[^/?#]+-(\d+)/?$", r"^/az/post/([^/?#]+)-\d+/?$", None),
}


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.trim(url), _URL, 2))


def url_path(url: Column) -> Column:
    """Path of an absolute address, else everything before ? and #."""
    u = F.trim(url)
    return F.when(u.rlike(_URL), F.regexp_extract(u, _URL, 3)).otherwise(F.regexp_extract(u, r"^([^?#]*)", 1))


def normalize_url(url: Column) -> Column:
    """Scheme, host as written and path without its last slashes; '/' for no path. Query and fragment are dropped."""
    u = F.trim(url)
    path = F.rtrim(F.regexp_extract(u, _URL, 3), F.lit("/"))
    whole = F.concat(F.regexp_extract(u, _URL, 1), F.lit("//"), F.regexp_extract(u, _URL, 2), F.when(path == "", "/").otherwise(path))
    return F.when(u.rlike(_URL), whole).otherwise(F.rtrim(u, F.lit("/")))


def _form(x: Column) -> Column:
    """A part of a query decoded and encoded again, as HTML forms write it."""
    spaced = F.replace(x, F.lit("+"), F.lit(" "))
    again = F.url_encode(F.coalesce(F.try_url_decode(x), spaced))
    return F.replace(F.replace(again, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonicalize_url(url: Column) -> Column:
    """Lower scheme and host, no tracking parameters, the others encoded alike and in order (blank ones too), no fragment, no last slash; null as ''."""
    u = F.regexp_replace(normalize_whitespace(url), "#.*$", "")
    base = F.substring_index(u, "?", 1)
    query = F.when(u.contains("?"), F.regexp_extract(u, r"\?(.*)$", 1)).otherwise("")
    name = lambda p: F.substring_index(p, "=", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.coalesce(F.try_url_decode(name(p)), name(p)).rlike(TRACKING))
    kept = F.array_join(F.transform(pairs, lambda p: F.concat(_form(name(p)), F.lit("="), _form(F.substr(p, F.length(name(p)) + 2)))), "&")
    host = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    low = F.concat(F.lower(host), F.substr(base, F.length(host) + 1))
    return F.rtrim(F.when(kept != "", F.concat(low, F.lit("?"), kept)).otherwise(low), F.lit("/"))


def resolve_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments, in one pass over its segments; what would climb beyond the root is dropped."""
    segments = F.split(path, "/")
    walk = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda done, x: F.when(x == ".", done).when(x == "..", F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)).otherwise(F.concat(done, F.array(x))),
    )
    whole = F.array_join(walk, "/")
    return F.when(F.element_at(segments, -1).isin(".", "..") & ~whole.endswith("/"), F.concat(whole, F.lit("/"))).otherwise(whole)


def make_absolute_url(base: Column, url: Column) -> Column:
    """``url`` as seen from the page ``base``; '' for ''. Dot segments are resolved whatever their depth."""
    u, root = F.trim(url), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(url_path(base), r"[^/]*$", "")
    tail = F.regexp_extract(u, r"([?#].*)$", 1)
    step = F.substr(u, F.lit(1), F.length(u) - F.length(tail))
    path = F.when(step.startswith("/"), step).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), step))
    return (
        F.when(u.isNull() | (u == ""), F.lit("")).when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), u)
        .when(u.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), u))
        .when(u.startswith("?"), F.concat(root, url_path(base), u))
        .when(u.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), u)).otherwise(F.concat(root, resolve_dots(path), tail))
    )


def unify_host(url: Column, hosts: list[str], to: str) -> Column:
    """The address at one host, if its host is one of several names of it."""
    return F.when(url_host(url).isin(hosts), F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", to)).otherwise(F.trim(url))


def extract_urls(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?i)(https?://\S+)"), F.lit(1)))


def looks_like_image(url: Column) -> Column:
    return F.substring_index(F.lower(F.coalesce(url, F.lit(""))), "?", 1).rlike(IMAGE)


def last_segment(url: Column) -> Column:
    return F.coalesce(F.element_at(F.split(F.rtrim(url_path(url), F.lit("/")), "/"), -1), F.lit(""))


def message_url(identifier: Column, message_id: Column) -> Column:
    """Public address of a channel message; '' without identifier or positive id."""
    peer = F.regexp_replace(F.regexp_extract(identifier, r"^peer:-?(\d+)$", 1), "^100", "")
    part = F.when(identifier.startswith("peer:"), F.concat(F.lit("c/"), peer)).otherwise(identifier)
    return F.when(F.coalesce(identifier, F.lit("")).eqNullSafe("") | F.coalesce(message_id <= 0, F.lit(True)), F.lit("")).otherwise(F.concat(F.lit("https://t.me/"), part, F.lit("/"), message_id.cast("string")))


def channel_identifier(x: Column) -> Column:
    """A channel's name or ``peer:N``, however it was written."""
    t = F.trim(x)
    bare = F.btrim(F.regexp_replace(t, r"^(https?://)?(t\.me/)?@?", ""), F.lit("/"))
    return F.when(t.startswith("peer:"), F.concat(F.lit("peer:"), F.trim(F.substr(t, F.lit(6))))).when(bare.rlike(r"^-?\d+$"), F.concat(F.lit("peer:"), bare)).otherwise(bare)


def source_key(identifier: Column) -> Column:
    return F.concat(F.lit("telegram:"), F.lower(channel_identifier(identifier)))


def _ladder(source: Column, url: Column, which: int) -> Column:
    path, out = url_path(url), None
    for portal, patterns in PATH_PATTERNS.items():
        if patterns[which]:
            part = F.regexp_extract(path, patterns[which], 1)
            out = F.when(source == portal, part) if out is None else out.when(source == portal, part)
    return out


def article_id(source: Column, url: Column) -> Column:
    """The id in an article's address, null if the portal's shape does not fit."""
    return F.nullif(_ladder(source, url, 0), F.lit("")).try_cast("bigint")


def article_slug(source: Column, url: Column) -> Column:
    return F.coalesce(_ladder(source, url, 1), F.lit(""))


def article_category(source: Column, url: Column) -> Column:
    return F.coalesce(_ladder(source, url, 2), F.lit(""))


def is_article_url(source: Column, url: Column) -> Column:
    """Whether the address has the shape of an article of its portal."""
    return article_id(source, url).isNotNull() | ((article_slug(source, url) != "") & source.isin("azxeber.com", "islamazeri.com", "ikisahil.az") & ~url_path(url).rlike(r"^/post/\d{5,}-share/?$"))
