"""Fields of pages by regular expressions, inside the JVM."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from presslake.functions.text import first_non_empty, normalize_space, normalize_whitespace


def strip_tags(x: Column) -> Column:
    """Text without markup; the five XML references and nbsp are resolved."""
    t = F.regexp_replace(F.regexp_replace(x, r"(?is)<(script|style)[^>]*>.*?</\1>", " "), r"<[^>]*>", "")
    for ref, c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(ref), F.lit(c))
    return normalize_space(t)


def tag_text(page: Column, tag: str) -> Column:
    """Text of the first element of a kind, '' if there is none."""
    return F.coalesce(strip_tags(F.regexp_extract(page, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)), F.lit(""))


def meta(page: Column, name: str) -> Column:
    """Content of a meta element by property, name or itemprop, attributes in either order."""
    a = F.regexp_extract(page, rf"(?is)<meta\s[^>]*(?:property|name|itemprop)\s*=\s*[\"']{name}[\"'][^>]*?content\s*=\s*[\"']([^\"']*)[\"']", 1)
    b = F.regexp_extract(page, rf"(?is)<meta\s[^>]*content\s*=\s*[\"']([^\"']*)[\"'][^>]*?(?:property|name|itemprop)\s*=\s*[\"']{name}[\"']", 1)
    return first_non_empty(a, b)


def canonical_url(page: Column, final_url: Column) -> Column:
    link = F.regexp_extract(page, r"(?is)<link\s[^>]*rel\s*=\s*[\"']canonical[\"'][^>]*?href\s*=\s*[\"']([^\"']*)[\"']", 1)
    return first_non_empty(link, meta(page, "og:url"), final_url)


def paragraphs(page: Column) -> Column:
    """Texts of the p elements, blank ones left out; an open p ends where the next begins."""
    parts = F.regexp_extract_all(page, F.lit(r"(?is)<p(?:\s[^>]*)?>(.*?)(?=</p>|<p[\s>]|$)"), F.lit(1))
    return F.filter(F.transform(parts, strip_tags), lambda t: t != "")


def page_title(page: Column) -> Column:
    return first_non_empty(meta(page, "og:title"), meta(page, "twitter:title"), tag_text(page, "title"), tag_text(page, "h1"))


def json_ld(page: Column) -> Column:
    """The JSON-LD scripts of a page."""
    return F.regexp_extract_all(page, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))


def json_ld_field(script: Column, field: str) -> Column:
    """A field of the top-level object, of the first list element or of the first graph entry."""
    return F.coalesce(*[F.get_json_object(script, f"{p}.{field}") for p in ("$", "$[0]", "$['@graph'][0]")], F.lit(""))


def embed_url(page: Column) -> Column:
    return normalize_whitespace(F.regexp_extract(page, r"(?is)<(?:iframe|video|source)\s[^>]*src\s*=\s*[\"']([^\"']+)[\"']", 1))


def js_string(page: Column, name: str) -> Column:
    """The decoded value of ``const name = "..."`` in a script, '' if there is none."""
    raw = F.regexp_extract(page, rf'(?s)(?:const|let|var)\s+{name}\s*=\s*("(?:[^"\\]|\\.)*")', 1)
    return F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), raw, F.lit("}")), "$.v"), F.lit(""))


def js_scalar(page: Column, key: str) -> Column:
    """``'key': 'value'`` or ``key = value`` in a script, '' if there is none."""
    return first_non_empty(F.regexp_extract(page, rf"['\"]{key}['\"]\s*:\s*['\"]([^'\"]*)['\"]", 1), F.regexp_extract(page, rf"\b{key}\s*=\s*['\"]?([\w.-]+)", 1))


def js_number(page: Column, key: str) -> Column:
    """``"key": 12`` in a script, '' if there is none."""
    return F.coalesce(F.regexp_extract(page, rf"['\"]{key}['\"]\s*:\s*(\d+)", 1), F.lit(""))


def element_by_class(page: Column, tag: str, name: str) -> Column:
    """Text of the first element of a kind whose class is ``name``, white space in order; '' if there is none."""
    inner = F.regexp_extract(page, rf'(?is)<{tag} class="{name}">(.*?)</{tag}>', 1)
    return F.coalesce(F.trim(F.regexp_replace(inner, r"\s+", " ")), F.lit(""))


def listing_cards(page: Column, pattern: str) -> Column:
    """array<struct<href, label>> of the cards of a listing, in order; the pattern has a group for each."""
    return F.arrays_zip(F.regexp_extract_all(page, F.lit(pattern), F.lit(1)).alias("href"), F.regexp_extract_all(page, F.lit(pattern), F.lit(2)).alias("label"))


def zipped_sitemap(xml: Column) -> Column:
    """array<struct<loc, lastmod>> of a sitemap by position: a missing lastmod shifts those after it, the last ones are null."""
    part = lambda tag: F.regexp_extract_all(xml, F.lit(rf"(?is)<{tag}>\s*(.*?)\s*</{tag}>"), F.lit(1))
    locs = part("loc")
    return F.slice(F.arrays_zip(locs.alias("loc"), part("lastmod").alias("lastmod")), F.lit(1), F.size(locs))


def first_image(tags: Column, base: Column) -> Column:
    """The first address of a list of attributes that is no inline picture, made absolute; '' if there is none."""
    from presslake.functions.urls import make_absolute_url

    wanted = F.filter(F.transform(tags, normalize_whitespace), lambda t: (t != "") & ~t.startswith("data:image"))
    return make_absolute_url(base, F.coalesce(F.try_element_at(wanted, F.lit(1)), F.lit("")))


def image_urls(page: Column) -> Column:
    """Addresses of all images of a page, by whichever attribute holds them, each once."""
    return F.array_distinct(F.regexp_extract_all(page, F.lit(r"(?is)<img\s[^>]*?(?:data-src|data-original|data-lazy-src|src)\s*=\s*[\"']([^\"']+)[\"']"), F.lit(1)))


def article_of(script: Column, kind: str = "NewsArticle") -> Column:
    """The first object of exactly this type at the top, in a list, or in a graph, as JSON; null if there is none."""
    top = F.coalesce(F.get_json_object(script, "$['@graph']"), script)
    items = F.when(F.ltrim(top).startswith("["), F.from_json(top, "array<string>")).otherwise(F.array(top))
    inner = F.flatten(F.transform(items, lambda x: F.coalesce(F.from_json(F.get_json_object(x, "$['@graph']"), "array<string>"), F.array(x))))
    return F.try_element_at(F.filter(inner, lambda x: F.get_json_object(x, "$['@type']") == kind), F.lit(1))


def breadcrumbs(script: Column) -> Column:
    """Names of a BreadcrumbList, from the outermost."""
    names = F.coalesce(F.get_json_object(script, "$.itemListElement[*].name"), F.get_json_object(script, "$.itemListElement[*].item.name"))
    listed = F.when(names.startswith("["), names).otherwise(F.concat(F.lit("["), names, F.lit("]")))
    return F.coalesce(F.from_json(listed, "array<string>"), F.array().cast("array<string>"))


def nested_of_type(script: Column, kind: str) -> Column:
    """The first object of a type (in any case) at any place and depth, in document order, as JSON; null if there is none or no JSON.

    Depth has no bound, so this is the one expression that leaves the JVM, in Arrow batches.
    """
    wanted = kind.lower()

    def first(text: str | None) -> str | None:
        try:
            stack = [json.loads(text or "null")]
        except ValueError:
            return None
        while stack:
            x = stack.pop()
            if isinstance(x, dict):
                types = x.get("@type")
                if wanted in [t.lower() for t in (types if isinstance(types, list) else [types]) if isinstance(t, str)]:
                    return json.dumps(x, ensure_ascii=False)
                stack += reversed(list(x.values()))
            elif isinstance(x, list):
                stack += reversed(x)
        return None

    def find(texts: pd.Series) -> pd.Series:
        return pd.Series([first(t) for t in texts], dtype=object)

    find.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(find, "string")(script)
