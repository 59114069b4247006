import pytest
from conftest import one
from pyspark.sql import functions as F

from presslake.functions import urls

# One row for each shape: portal, path, id, slug, category.
SHAPES = [
    ("sonxeber.az", "/700001/alma-bagi", 700001, "alma-bagi", ""), ("sonxeber.az", "/700001/", 700001, "", ""), ("sonxeber.az", "/70001/alma", None, "", ""),
    ("oxu.az", "/en/70001/", 70001, "", ""), ("oxu.az", "/701", None, "", ""), ("report.az", "/70002/", 70002, "", ""), ("azertag.az", "/az/xeber/71", 71, "", ""), ("azertag.az", "/ru/xeber/71", None, "", ""),
    ("metbuat.az", "/news/72/alma.html", 72, "alma", ""), ("metbuat.az", "/news/72/alma/", 72, "alma", ""), ("metbuat.az", "/news/72", 72, "", ""),
    ("yenixeber.az", "/alma-2-bag-73/", 73, "alma-2-bag", ""), ("yenixeber.az", "/bolme/alma-73", None, "", ""),
    ("teleqraf.az", "/news/bag/74.html", 74, "", "bag"), ("teleqraf.az", "/news/bag/74.html/", 74, "", "bag"), ("axar.az", "/news/bag/75.html/", 75, "", "bag"), ("axar.az", "/news/bag/", None, "", ""),
    ("milli.az", "/bag/76.html/", 76, "", "bag"), ("milli.az", "/tag/76.html", None, "", ""), ("azerbaijan.az", "/news/77/", 77, "", ""),
    ("ikisahil.az", "/post/70078-alma-bagi", 70078, "alma-bagi", ""), ("ikisahil.az", "/post/7-alma", None, "7-alma", ""), ("ikisahil.az", "/post/70078-share", None, "", ""),
    ("azxeber.com", "/az/alma-bagi/bag/", None, "alma-bagi", "bag"), ("azxeber.com", "/az/bag/", None, "", ""),
    ("apa.az", "/bag/alma-bagi-79", 79, "alma-bagi", "bag"), ("apa.az", "/bag/-79", -79, "", "bag"), ("apa.az", "/bag/79/", 79, "", "bag"), ("apa.az", "/bag", None, "", ""),
    ("xeberler.az", "/new/details/alma:-bag--80.htm", 80, "alma:-bag", ""), ("xeberler.az", "/new/details/alma--80.htm/", 80, "alma", ""), ("siyasetinfo.az", "/810/", 810, "", ""), ("siyasetinfo.az", "/81", None, "", ""),
    ("yeniazerbaycan.com", "/Bag_e82_az.html/", 82, "", "Bag"), ("yeniazerbaycan.com", "/Bag_alma_e82_az.html", None, "", ""), ("islam.az", "/8300/alma/", 8300, "alma", ""), ("islam.az", "/830/alma/", None, "", ""),
    ("islamazeri.com", "/image/haber/10x20/alma-84.jpeg", 84, "", ""), ("islamazeri.com", "/IMAGE/haber/alma-84.JPG", 84, "", ""), ("islamazeri.com", "/alma84.html/", None, "alma84", ""),
    ("sia.az", "/az/news/bag/85.html/", 85, "", "bag"), ("sia.az", "/az/latest/85.html", None, "", ""), ("1news.az", "/az/news/20260101000000001-Alma-bag", 20260101000000001, "Alma-bag", ""), ("1news.az", "/az/news/2026", None, "", ""),
    ("iqtisadiyyat.az", "/az/post/alma-12-86/", 86, "alma-12", ""), ("nowhere.az", "/87", None, "", ""),
]
ARTICLES = {("azxeber.com", "/az/alma-bagi/bag/"), ("islamazeri.com", "/alma84.html/"), ("ikisahil.az", "/post/7-alma")}


def test_portal_paths(spark):
    df = spark.createDataFrame([(i, s, f"https://www.{s}{path}?q=1#t") for i, (s, path, *_) in enumerate(SHAPES)], "i int, s string, u string")
    s, u = F.col("s"), F.col("u")
    got = {r.i: r for r in df.select("i", urls.article_id(s, u).alias("id"), urls.article_slug(s, u).alias("slug"), urls.article_category(s, u).alias("category"), urls.is_article_url(s, u).alias("valid")).collect()}
    for i, (portal, path, *want) in enumerate(SHAPES):
        assert [got[i].id, got[i].slug, got[i].category] == want, (portal, path)
        assert got[i].valid == (want[0] is not None or (portal, path) in ARTICLES), (portal, path)


@pytest.mark.parametrize(("given", "want"), [
    ("https://a.az/x/", "https://a.az/x"), (" https://a.az ", "https://a.az/"), ("https://A.az/x/?q=1#f", "https://A.az/x"), ("a.az/x/", "a.az/x"), ("", ""), (None, None),
])
def test_normalize_url(spark, given, want):
    assert one(spark, urls.normalize_url(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize(("given", "want"), [
    ("HTTPS://A.az/X?utm_source=q&b=2&fbclid=1#z", "https://a.az/X?b=2"), ("https://a.az/?gclid=3", "https://a.az"), (None, ""), ("https://B.az/y?c=&d=2", "https://b.az/y?c=&d=2"), ("http://b.az/y?c=1 2&%75tm_x=1&d=%C3%BC*~", "http://b.az/y?c=1+2&d=%C3%BC%2A~"), ("http://b.az/y?c&&%zz", "http://b.az/y?c=&%25zz="),
])
def test_canonicalize_url(spark, given, want):
    assert one(spark, urls.canonicalize_url(F.lit(given).cast("string"))) == want


@pytest.mark.parametrize(("base", "url", "want"), [
    ("https://a.az/x/y", "z", "https://a.az/x/z"), ("https://a.az/x/y", "/z", "https://a.az/z"), ("https://a.az/x/y", "//b.az/z", "https://b.az/z"),
    ("https://a.az/x/y/w", "../z", "https://a.az/x/z"), ("https://a.az/x", "?q", "https://a.az/x?q"), ("https://a.az", "z", "https://a.az/z"), ("https://a.az/x", "", ""), ("https://a.az/x", "https://c.az/", "https://c.az/"), ("https://a.az/b/c/d/e/f/g/h/i", "../../../../../../../z?q=../x", "https://a.az/z?q=../x"), ("https://a.az/b/c", "../../../z", "https://a.az/z"), ("https://a.az/b/c", "./z/.", "https://a.az/b/z/"), ("https://a.az/b/c", "..", "https://a.az/"),
])
def test_make_absolute(spark, base, url, want):
    assert one(spark, urls.make_absolute_url(F.lit(base), F.lit(url))) == want


def test_channel_addresses(spark):
    assert one(spark, urls.message_url(F.lit("peer:-1001234"), F.lit(5))) == "https://t.me/c/1234/5"
    assert one(spark, urls.message_url(F.lit("chan"), F.lit(5))) == "https://t.me/chan/5"
    assert one(spark, urls.message_url(F.lit(""), F.lit(5))) == ""
    assert one(spark, urls.source_key(F.lit("https://t.me/Chan/"))) == "telegram:chan"
    assert one(spark, urls.source_key(F.lit("-100777"))) == "telegram:peer:-100777"
    assert one(spark, urls.extract_urls(F.lit("a https://x.y/z b http://q https://x.y/z"))) == ["https://x.y/z", "http://q"]
    assert one(spark, urls.unify_host(F.lit("http://m.a.az/x?y"), ["m.a.az", "www.a.az"], "https://a.az")) == "https://a.az/x?y"
    assert one(spark, urls.unify_host(F.lit("http://b.az/x"), ["m.a.az"], "https://a.az")) == "http://b.az/x"
    assert one(spark, urls.looks_like_image(F.lit("https://a/b.JPG?x=1"))) is True
