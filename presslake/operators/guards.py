"""Validity of candidates, pages and outcomes as columns: rows stay, and say why they are left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.functions.text import normalize_space
from presslake.functions.urls import normalize_url, url_host, url_path

# States of pages that are gone, and parts of the messages of probes that found no article.
GONE = [404, 410]
NO_ARTICLE = ["invalid canonical url", "missing content container", "missing milli article id", "missing axar article id", "missing title"]


def reasons(**tests: Column) -> Column:
    """Names of the tests that a row fails (a null test fails), in order."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in tests.items()]), lambda x: x.isNotNull())


def quarantine(df: DataFrame, why: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows with reasons)."""
    return df.where(F.size(why) == 0).drop(why), df.where(F.size(why) > 0)


def at_host(url: Column, host: Column, other_languages: list[str]) -> Column:
    """Whether an address is at a host (or its www), has a path, and is no page of another language."""
    path = F.rtrim(url_path(url), F.lit("/"))
    foreign = [(path == p.rstrip("/")) | path.startswith(p.rstrip("/") + "/") for p in other_languages]
    ok = url_host(url).isin(host, F.concat(F.lit("www."), host)) if isinstance(host, str) else (url_host(url) == host) | (url_host(url) == F.concat(F.lit("www."), host))
    for f in foreign:
        ok = ok & ~f
    return ok & (path != "")


def in_language(lang: Column, wanted: str) -> Column:
    """Whether an entry names no language, or this one."""
    return F.coalesce(lang, F.lit("")).isin("", wanted)


def not_redirected(asked: Column, final: Column) -> Column:
    """Whether a request ended at the page it asked for."""
    return normalize_url(asked) == normalize_url(final)


def no_error_page(title: Column, marks: list[str], body_class: Column | None = None, error_class: str = "error404") -> Column:
    """Whether neither title nor class of the body are those of an error page."""
    ok = F.lit(True)
    for m in marks:
        ok = ok & ~F.coalesce(title, F.lit("")).contains(m)
    return ok if body_class is None else ok & ~F.array_contains(F.split(F.coalesce(body_class, F.lit("")), " "), error_class)


def no_banner(classes: Column, banned: list[str]) -> Column:
    """Whether the classes of a card have none of the banned ones."""
    return ~F.arrays_overlap(F.split(F.coalesce(classes, F.lit("")), " "), F.array(*[F.lit(b) for b in banned]))


def in_categories(categories: Column, wanted: list[str]) -> Column:
    """Whether a category is among the wanted ones, whatever its case and white space."""
    return F.exists(categories, lambda c: F.lower(normalize_space(c)).isin([w.lower() for w in wanted]))


def no_leading_digit(slug: Column) -> Column:
    return ~slug.rlike("^[0-9]")


def no_corrupt_date(date_text: Column, start: str = "30.11.-0001") -> Column:
    return ~F.coalesce(date_text, F.lit("")).startswith(start)


def accepted_probe(asked_id: Column, found_id: Column) -> Column:
    """Whether a probe found what it asked for; a probe that asked for no id takes anything."""
    return asked_id.isNull() | F.coalesce(asked_id == found_id, F.lit(False))


def ignorable(status: Column, message: Column) -> Column:
    """Whether the error of a probe says no more than that there is no article."""
    text = F.lower(normalize_space(F.coalesce(message, F.lit(""))))
    found = status.isin(GONE)
    for part in NO_ARTICLE:
        found = found | text.contains(part)
    return F.coalesce(found, F.lit(False))


def outcome(status: Column, message: Column) -> Column:
    """``ok``, ``skipped`` (the page is gone) or ``error``."""
    failed = F.coalesce(message, F.lit("")) != ""
    return F.when(status.isin(GONE), "skipped").when(failed | (status >= 400), "error").otherwise("ok")


def error_label(item_id: Column, url: Column, message: Column) -> Column:
    """``id: message``, with the address where the id is unknown."""
    return F.concat(F.coalesce(item_id.cast("string"), url, F.lit("")), F.lit(": "), F.coalesce(message, F.lit("")))


def counters(outcomes: DataFrame, by: list[str], kind: str, action: str) -> DataFrame:
    """(by..., n_listing, n_new, n_updated, n_skipped, n_errors) of a run in one pass over its outcomes."""
    n = lambda c: F.count_if(c)
    ok = F.col(kind) == "ok"
    return outcomes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_listing"), n(ok & (F.col(action) == "inserted")).alias("n_new"), n(ok & (F.col(action) == "updated")).alias("n_updated"),
        n(F.col(kind) == "skipped").alias("n_skipped"), n(F.col(kind) == "error").alias("n_errors"),
    )
