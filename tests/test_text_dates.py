import hashlib

import pytest
from conftest import one
from pyspark.sql import functions as F

from presslake.functions import dates, html, text

L = F.lit


@pytest.mark.parametrize(("expr", "want"), [
    (lambda: text.normalize_space(L(" a  b\n c ")), "a b c"), (lambda: text.normalize_whitespace(L(None).cast("string")), ""), (lambda: text.first_non_empty(L(" "), L(None).cast("string"), L(" x  y ")), "x y"),
    (lambda: text.summarize_text(L("a" * 300)), "a" * 277 + "..."), (lambda: text.fix_utf8_mojibake(L("Ã¼")), "ü"), (lambda: text.fix_utf8_mojibake(L("şə")), "şə"), (lambda: text.published_date_raw(L("x Tarix: 1 may")), "1 may"),
    (lambda: text.unique_in_order(F.array(L("b"), L(""), L("a"), L("b"))), ["b", "a"]), (lambda: text.clean_teaser(L(" mətn davamı . ")), "mətn"), (lambda: text.title_from_content(L("a b c\nd"), 2), "a b"),
    (lambda: text.message_title(L(""), L("Bir. İki"), L(None).cast("string")), "Bir"), (lambda: text.message_title(L(""), L(""), L("photo")), "[telegram media post] photo"),
    (lambda: text.safe_int(L(" 12 ")), 12), (lambda: text.safe_int(L("x")), None), (lambda: text.primary_category(F.array(L("Home"), L(" Din ")), ["home"], L("X")), "Din"), (lambda: text.primary_category(F.array(L("Home"), L("xəbərlər")), ["home", "xəbərlər"], L(""), "Xəbərlər", ["home"]), "Xəbərlər"), (lambda: text.primary_category(F.array(L("Home"), L("Y")), ["home", "y"], L(""), "Z", ["home"]), "Y"), (lambda: text.primary_category(F.array(L("Home")), ["home"], L(""), "Z", ["home"]), ""), (lambda: text.safe_name(L("a/b:c")), "a_b_c"),
    (lambda: text.sha256_text(L(None).cast("string")), hashlib.sha256(b"").hexdigest()), (lambda: text.stable_bigint(L("abc")), int.from_bytes(hashlib.sha256(b"abc").digest()[:8]) & (2**63 - 1)),
    (lambda: text.dedupe_key(L(""), L("h"), L("t"), L("2026-01-02 03:04:05")), "hash:h"), (lambda: text.dedupe_key(L("u"), L("h"), L("t"), L("d")), "url:u"), (lambda: text.dedupe_key(L(""), L(""), L(" A  b"), L("2026-01-02 03:04:05").cast("timestamp")), "sim:" + hashlib.sha256("a b|2026-01-02".encode()).hexdigest()),
    (lambda: text.message_title(L(""), L(""), L("")), ""), (lambda: text.media_body(L(" "), L("photo")), "[telegram media post without caption] photo"), (lambda: text.media_body(L("a  b"), L("photo")), "a b"), (lambda: text.kept_paragraphs(F.array(L("The post x"), L("a"), L("b Views: 3"), L("S")), ["The post "], ["Views:"], ["S"]), ["a"]), (lambda: F.length(text.record_uuid(L("a"), L("b"))), 36),
])
def test_text(spark, expr, want):
    assert one(spark, expr()) == want


@pytest.mark.parametrize(("expr", "want"), [
    (lambda: dates.azerbaijani_date(L("3 mart 2031"), L(2000)), "2031-03-03"), (lambda: dates.azerbaijani_date(L("19 Noyabr"), L(2024)), "2024-11-19"), (lambda: dates.azerbaijani_date(L("5 İyul 2031"), L(2024)), ""), (lambda: dates.azerbaijani_date(L("30 fevral 2031"), L(2000)), ""), (lambda: dates.azerbaijani_date(L("sabah"), L(2000)), ""),
    (lambda: dates.azerbaijani_date(L("8 avgust 2026"), L(2000)), "2026-08-08"), (lambda: dates.azerbaijani_date(L("8 avqust 2026"), L(2000)), "2026-08-08"),
    (lambda: dates.azerbaijani_datetime(L("3 mart 2031"), L("6:45"), L(2000)), "2031-03-03T06:45:00+04:00"), (lambda: dates.azerbaijani_datetime(L("3 mart 2031"), L("24:45"), L(2000)), "2031-03-03"),
    (lambda: dates.rfc2822(L("Mon, 03 Mar 2031 06:45:07 +0230")), "2031-03-03T06:45:07+02:30"), (lambda: dates.rfc2822(L("Mon")), ""), (lambda: dates.azertag_datetime(L("2031-03-03 06:45:07")), "2031-03-03T06:45:07+04:00"), (lambda: dates.azertag_datetime(L(" dünən ")), "dünən"),
    (lambda: dates.axar_datetime(L("2031.03.03 / 06:45")), "2031-03-03T06:45:00+04:00"), (lambda: dates.axar_datetime(L("2031.03 / 06:45")), "2031.03 / 06:45"), (lambda: dates.xeberler_datetime(L("03-03-2031 / 06:45")), "2031-03-03T06:45:00+04:00"), (lambda: dates.xeberler_datetime(L("03-03-2031")), "2031-03-03"),
    (lambda: dates.xeberler_datetime(L("2031-03-03+06:45:07-0130")), "2031-03-03T06:45:07-01:30"), (lambda: dates.islamazeri_datetime(L("x 3/13/2031 6:45:07 pm4")), "2031-03-13T18:45:07+04:00"), (lambda: dates.islamazeri_datetime(L("3/13/2031 18:45:07 PM")), ""), (lambda: dates.islamazeri_datetime(L("3/13/2031 12:05:07 AM")), "2031-03-13T00:05:07+04:00"),
    (lambda: dates.apa_datetime(L("3 mart 2031 06:45 (UTC +04:00)"), L(2000)), "2031-03-03T06:45:00+04:00"), (lambda: dates.iqtisadiyyat_datetime(L("2031-03-03T06:45:07.5Z")), "2031-03-03T06:45:07+00:00"),
    (lambda: dates.iqtisadiyyat_datetime(L("Mon Mar 03 2031 06:45:07 GMT-0300 (Some Zone)")), "2031-03-03T06:45:07-03:00"), (lambda: dates.yeniazerbaycan_datetime(L("03.03.2031 [06:45]")), "2031-03-03T06:45:00+04:00"),
    (lambda: dates.yeniazerbaycan_datetime(L("2031-03-03")), "2031-03-03T00:00:00+04:00"), (lambda: dates.visible_datetime(L("3 mart 2031 06:45"), L(2000)), "2031-03-03T06:45:00+04:00"), (lambda: dates.visible_datetime(L("3 mart"), L(2030)), "2030-03-03"), (lambda: dates.at_fixed_offset(L("2031-03-03T22:45:07-01:00")), "2031-03-04T03:45:07+04:00"),
    (lambda: dates.iso_or_dotted_date(L("13.03.2031")), "2031-03-13"), (lambda: dates.iso_or_dotted_date(L("13.13.2031")), ""), (lambda: dates.iso_with_offset(L("2031-03-03T06:45:07")), "2031-03-03T06:45:07+04:00"), (lambda: dates.iso_with_offset(L(None).cast("string")), ""),
    (lambda: dates.schema_datetime(L("03.03.2031 06:45:07")), "2031-03-03T06:45:07+04:00"), (lambda: dates.schema_datetime(L("2031-03-03 06:45:07")), "2031-03-03T06:45:07+04:00"), (lambda: dates.schema_datetime(L("2031-03-03T06:45:07Z")), "2031-03-03T06:45:07+00:00"), (lambda: dates.feed_datetime(L("dünən")), "dünən"), (lambda: dates.feed_datetime(L("2031-03-03T06:45:07Z")), "2031-03-03T10:45:07+04:00"),
    (lambda: dates.card_datetime(L("3 mart 2031"), L("06:45"), L(2000)), "2031-03-03T06:45:00+04:00"), (lambda: dates.card_datetime(L("3 mart 2031 06:45"), L(""), L(2000)), "2031-03-03T06:45:00+04:00"),
    (lambda: F.unix_seconds(dates.first_instant([L("x"), L(""), L("2031-03-03T06:45:07Z")], L("2000-01-01").cast("timestamp"))), 1930286707), (lambda: F.unix_seconds(dates.first_instant([L("x")], L("1970-01-01 00:00:05Z").cast("timestamp"))), 5), (lambda: F.unix_seconds(dates.heartbeat(L("no time"))), 0),
])
def test_dates(spark, expr, want):
    assert one(spark, expr()) == want


def test_html(spark):
    page = '<html><head><title>T &amp; U</title><meta content="O" property="og:title"><link rel="canonical" href="https://a.az/x"></head><body><script>var p="<p>no</p>"</script><h1>H <b>x</b></h1><p>One<p class=a>Two&nbsp;</p><p> </p></body></html>'
    assert one(spark, html.page_title(L(page))) == "O"
    assert one(spark, html.tag_text(L(page), "title")) == "T & U"
    assert one(spark, html.canonical_url(L(page), L("https://b"))) == "https://a.az/x"
    assert one(spark, html.paragraphs(L(page)))[-2:] == ["One", "Two"]
    assert one(spark, html.json_ld_field(L('[{"headline":"x"}]'), "headline")) == "x"
    assert one(spark, html.page_title(L(""))) == ""


def test_scripts(spark):
    assert one(spark, html.js_string(L('x; const rawContent = "a\\u0131 \\"b\\"";'), "rawContent")) == 'aı "b"'
    assert one(spark, html.js_scalar(L("{'xid': '77', a}"), "xid")) == "77"
    assert one(spark, html.js_scalar(L("currentPostId = 15;"), "currentPostId")) == "15"
    assert one(spark, html.js_scalar(L(None).cast("string"), "x")) == ""
    crumbs = '{"@type":"BreadcrumbList","itemListElement":[{"name":"A"},{"name":"B"}]}'
    assert one(spark, html.breadcrumbs(L(crumbs))) == ["A", "B"]
    assert one(spark, html.breadcrumbs(L("no json"))) == []
    deep = '{"@graph":[{"x":{"@type":"NewsArticle","headline":"H"}},{"@type":"WebSite"}]}'
    assert one(spark, F.get_json_object(html.nested_of_type(L(deep), "newsarticle"), "$.headline")) == "H"
    assert one(spark, html.nested_of_type(L("[]"), "newsarticle")) is None
