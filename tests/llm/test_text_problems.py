import collections
import re

import pytest
from pyspark.sql import functions as F

from presslake.llm import boilerplate, canonical, encoding, language, lines, queries

TR = "Toplantıda yeni proje görüşüldü ve çalışmaların yıl sonuna kadar tamamlanacağı söylendi. Işıl öğretmen ağaçları gösterdi."
RU = "В мероприятии приняли участие более ста гостей, и совещание закончилось поздно вечером. Новый проект обсудили подробно."
AZ = "Görüşdə tərəflər ikitərəfli əlaqələrin inkişafını müzakirə ediblər, işlər başa çatdırılacaq. Şəhərdə yağış yağdı."
EN = "The team won the match after scoring late, and the ministry stated that the road would be finished soon."


@pytest.fixture(scope="module")
def dicts(spark):
    rows = [(i, lang, f"{t} {i % 7}") for i, (lang, t) in enumerate([("tr", TR), ("ru", RU), ("az", AZ), ("en", EN)] * 12)]
    return encoding.train_dictionaries(spark.createDataFrame(rows, "id int, lang string, t string"), "id", "lang", "t")


def garble(t, *chain):
    for page in chain:
        t = "".join(encoding._DECODE[page][b] for b in t.encode())
    return t


@pytest.mark.parametrize("chain", [("latin-1",), ("cp1252",), ("cp1251",), ("cp1252", "cp1252"), ("cp1252", "latin-1")])
@pytest.mark.parametrize("text", [TR, RU, AZ, "“" + EN + "”"])
def test_encoding_round_trip(dicts, chain, text):
    assert encoding.repair("ok\n" + garble(text, *chain), encoding._compressors(tuple(dicts))) == "ok\n" + text


def test_single_byte_pages(dicts):
    c = encoding._compressors(tuple(dicts))
    assert encoding.repair(RU.encode("cp1251").decode("latin-1"), c) == RU
    assert encoding.repair(TR.encode("cp1254").decode("latin-1"), c) == TR
    for clean in (TR, RU, AZ, EN, "São Paulo və Malmö", "", "\n \n"):
        assert encoding.repair(clean, c) is None


@pytest.mark.parametrize("step", [s[:2] for s in encoding.STEPS if {"koi8-r", "cp866"} & set(s[:2])])
@pytest.mark.parametrize("text", [RU, "Дилзир Товтерович посетил город", RU.lower(), RU.upper()])
def test_cyrillic_pages(dicts, step, text):
    page, real = step
    bad = "".join(encoding._DECODE[page][b] for b in encoding.codecs.charmap_encode(text, "strict", encoding._ENCODE[real])[0]) if real != "utf-8" else garble(text, page)
    assert encoding.repair(bad, encoding._compressors(tuple(dicts))) == text


def test_no_reading_is_overlooked():
    """Whatever page UTF-8 was read with, the quick test for it lets the text through; other text beyond ASCII is not tested at all."""
    for page, table in encoding._DECODE.items():
        for cp in [*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x10000, 0x110000, 61)]:
            bad = "".join(table[b] for b in chr(cp).encode())
            assert (page, chr(cp)) in encoding.utf8_readings(bad) if cp % 97 == 0 else encoding._AS_UTF8.search(bad) and not encoding._FOREIGN.search(bad)
            assert re.search(encoding.BEYOND_ASCII, bad)


@pytest.mark.parametrize(("page", "real"), [(p, r) for p, r, _ in encoding.STEPS if r in encoding.CYRILLIC and "mac-cyrillic" not in (p, r)])
def test_every_pair_of_pages(dicts, page, real):
    for text in (RU, RU.lower(), "Дилзир Товтерович посетил город"):
        raw = encoding.codecs.charmap_encode(text, "strict", encoding._ENCODE[real])[0]
        assert encoding.repair("".join(encoding._DECODE[page][b] for b in raw), encoding._compressors(tuple(dicts))) == text


def test_turkish_read_as_cyrillic(dicts):
    assert encoding.repair(TR.encode("cp1254").decode("cp1251"), encoding._compressors(tuple(dicts))) == TR


def test_clean_cyrillic_stays(dicts):
    for clean in (RU.upper(), "ВКонтакте и ОБСЕ", "ВАЖНОЕ СООБЩЕНИЕ", "Чей это новый жюри", "Фото: АПА"):
        assert encoding.repair(clean, encoding._compressors(tuple(dicts))) is None


def test_encoding_cases(spark, dicts):
    df = spark.createDataFrame([(1, garble(AZ, "cp1252"), "x"), (2, None, "x"), (3, "", "x"), (4, "a�b", "x"), (5, AZ * 200, "x"), (1, garble(AZ, "cp1252"), "x")], "id int, v string, value string")
    got = sorted((r.id, r.affected, r.restored) for r in encoding.repair_encoding(df, "v", dicts).collect())
    assert got == [(1, True, AZ), (1, True, AZ), (2, False, None), (3, False, None), (4, True, None), (5, False, None)]
    assert encoding.repair_encoding(df.limit(0), "v", []).count() == 0
    assert encoding.train_dictionaries(spark.createDataFrame([], "id int, lang string, t string"), "id", "lang", "t") == []


REF = [(1, ("Siyasət", "Политика", "Politics")), (13, ("Dini həyat", "Религия", "Religion")), (8, ("Texnologiya", "Технологии", "Technology")), (17, ("Ekologiya", "Экология", "Environment"))]


def osa(a, b):
    d = {(i, j): max(i, j) for i in range(len(a) + 1) for j in range(len(b) + 1) if not i * j}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_trie_finds_what_brute_force_finds():
    words = ["siyaset", "politics", "dinihyat", "texnolgiya", "ekologya", "religoin", "xyz", "siya", "environmnet", "sset"]
    aliases = sorted({(canonical.key_of(n), i) for i, names in REF for n in names})
    trie = canonical.Trie(aliases)
    for w in words:
        want = {}
        for a, i in aliases:
            if (d := osa(w, a)) <= canonical.reach(len(a)):
                want[i] = min(want.get(i, 9), d)
        assert trie.search(w) == want, w


@pytest.mark.parametrize(("value", "want"), [
    ("SIYASƏT", 1), ("Syiasət", 1), ("Политика – новости", 1), ("Home » Politics", 1), ("#Dinihəyat", 13), ("həyat Dini", 13), ("Dini hə…", 13), ("Texnolog.", 8), ("Horoskop", None), ("cat_0917", None), ("???", None), ("", None), (None, None), ("x" * 9999, None), ("17", None), ("Əsas səhifə / " * 40 + "Siyasət", 1), ("Siyasət xəbərləri" + "/" * 500, 1),
])
def test_values(spark, value, want):
    df = spark.createDataFrame([(value, 1)], "v string, ref_id int")
    m = canonical.with_matches(df, "v", REF).collect()[0].matches
    assert (m[0].ref_id if m else None) == want
    assert canonical.with_matches(df, "v", []).collect()[0].matches == []


def test_repeated_lines_against_brute_force(spark, monkeypatch):
    docs = [(i, "p" if i % 3 else "q", f"Unique {chr(97 + i % 26)}{i}x\n Views: {i}  times \n\nShare it\nOwn {'z' * i}") for i in range(60)]
    docs += [(100, "p", None), (101, "p", ""), (102, "p", " \n\t"), (103, None, "Share it"), (104, "r", "Share it"), (105, "p", "Share it\nShare it")]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "id int, src string, t string, h string")
    norm = lambda x: re.sub("[0-9]+", "0", re.sub("[ \t ]+", " ", x).strip(" "))
    split = lambda t: [x for x in t.split("\n") if x.strip(" \t ")]
    count, total = collections.Counter(), collections.Counter()
    for _, s, t in docs:
        if s and t:
            total[s] += 1
            count.update((s, x) for x in {norm(y) for y in split(t)})
    want = sorted((i, n) for i, s, t in docs if s and t for n, x in enumerate(split(t), 1) if count[s, norm(x)] >= max(5, 0.05 * total[s]))
    assert sorted((r.id, r.line_no) for r in lines.repeated_places(df, "id", "src", "t").collect()) == want
    clean = {r.id: (r.clean_text, r.n_removed) for r in lines.without_repeated(df, "id", "src", "t").collect()}
    assert clean[105] == ("", 2) and clean[100] == (None, 0) and clean[103] == ("Share it", 0) and "Share" not in clean[1][0]
    assert lines.repeated_places(df.limit(0), "id", "src", "t").count() == 0
    monkeypatch.setattr(lines, "MAX_BROADCAST_ROWS", 0)  # the other way
    assert sorted((r.id, r.line_no) for r in lines.repeated_places(df, "id", "src", "t").collect()) == want
    assert {r.id: (r.clean_text, r.n_removed) for r in lines.without_repeated(df, "id", "src", "t").collect()} == clean


def test_phrases_against_brute_force():
    text = " salam dünya salamat "
    a = language.SuffixAutomaton(text)

    def brute(w):
        n = at = 0
        while at < len(w):
            k = at
            while k < len(w) and w[at : k + 1] in text:
                k += 1
            at, n = max(k, at + 1), n + 1
        return n

    for w in (" salam ", " dünyamat ", "xyz", "", "sal sal"):
        assert a.phrases(w) == brute(w)


def test_languages(spark):
    rows = [(i, lang, t) for i, (lang, t) in enumerate([("tr", TR), ("ru", RU), ("az", AZ), ("en", EN)] * 3)]
    models = language.train_models(spark.createDataFrame(rows, "id int, l string, t string"), "id", "l", "t")
    df = spark.createDataFrame([(1, f"{AZ}\n\nhttps://x.example/a #tag\n{RU}\n{RU}\n{AZ}"), (2, None), (3, ""), (4, "#a #b https://q.example"), (5, EN * 300), (6, TR)], "id int, t string")
    got = {r.id: [s.lang for s in r.stretches] for r in language.label_stretches(df, "t", models, ["id"]).collect()}
    assert got == {1: ["az", "ru", "az"], 2: [], 3: [], 4: [], 5: ["en"], 6: ["tr"]}
    assert language.train_models(spark.createDataFrame([], "id int, l string, t string"), "id", "l", "t") == ()
    labels = spark.createDataFrame([("az-Latn_AZ",), ("RUS",), ("und",), ("",), (None,), (" tr_TR ",), ("kk",)], "l string")
    assert [r[0] for r in labels.select(language.language_of_label(F.col("l"))).collect()] == ["az", "ru", None, None, None, "tr", None]


def test_tables_count_what_the_automaton_counts(spark):
    rows = [(i, lang, t) for i, (lang, t) in enumerate([("tr", TR), ("ru", RU), ("az", AZ), ("en", EN)] * 3)]
    models = language.train_models(spark.createDataFrame(rows, "id int, l string, t string"), "id", "l", "t")
    scorer = language.Scorer(models)
    automata = [language.SuffixAutomaton(t) for _, t in models]
    lines = ["Görüşdə yeni 3 proje,", EN, RU.upper(), "日本語 mətn", "x", "q" * 30, AZ + " " + TR, "#tag https://a.example 12"]
    got = scorer.lines(lines)
    assert got[-1] is None
    for line, (letters, phrases) in zip(lines, got[:-1]):
        words = language._WORD.findall(line)
        assert letters == sum(map(len, words))
        assert list(phrases) == [a.phrases(language.fold(f" {' '.join(words)} ")) for a in automata]
    assert scorer.stretches([RU.upper(), None, "", "http://localhost/x", "GCQ/172 RWQ/881 XYZ/100", "W" * 5000])[0][1][0][0] == "ru"
    assert [len(s) for _, s in scorer.stretches([RU.upper(), None, "", "http://localhost/x", "GCQ/172 RWQ/881 XYZ/100", "W" * 5000])] == [1, 0, 0, 0, 0, 0]
    assert [x for x, _ in scorer.stretches([f"{EN}\nFoto\n{EN}\n{garble(RU, 'cp1252')}"])[0][1]] == ["en", "ru"]


STORY = "Uzun bir cümlə burada yazılıb və oxucu üçün maraqlı olan bir xəbərdir {}."
PAGE = '<html><head><title>T</title></head><body><ul><li><a href=/>Siyasət</a></li></ul><div class="b{0} w"><h1>Başlıq</h1><p>{1}<p>{2}<aside>Həmçinin oxuyun: <a>X {0}</a></aside></div><div class=r><h3>Digər xəbərlər</h3><div class=item><a>Y {0}</a></div></div><div class=f><p>© 2020 Sayt</p></div></body></html>'


def test_boilerplate(spark):
    pages = [(i, "h", PAGE.format(i, STORY.format("a" * i), STORY.format("b" * i))) for i in range(1, 9)]
    pages += [(50, "h", "<html><body><h1>404</h1></body></html>"), (51, "h", None), (52, "h", ""), (53, None, "<p>qırıq <b"), (54, "h", "x" * 100_000)]
    read = boilerplate.read_pages(spark.createDataFrame(pages, "i int, host string, html string"), "html", ["i", "host"])
    won = boilerplate.winning_paths(read, "host")
    assert {r.w_host: r.paths for r in won.collect()}["h"] == ["div.b.w>p"]
    stories = boilerplate.with_story(read, won, "host")
    got = {r.i: r.story for r in stories.collect()}
    assert got[3] == [STORY.format("aaa"), STORY.format("bbb")] and not got[50] and not got[51] and not got[52] and not got[54]
    known = [(r.kind, r.text) for r in boilerplate.boilerplate_texts(stories, "host").collect()]
    shapes = boilerplate.story_shapes(stories)
    assert ("head", "Digər xəbərlər") in known and ("block", "Siyasət") in known and ("pointer", "Həmçinin oxuyun") in known
    text = "\n".join(["Siyasət | Siyasət", STORY.format("c"), "Həmçinin oxuyun: Nə isə", STORY.format("d"), "Digər xəbərlər", "12:10 Qısa başlıq", "© 2021 Sayt"])
    df = spark.createDataFrame([(1, text, "B"), (2, STORY.format("e"), "B"), (3, None, None), (4, "", "")], "i int, t string, h string")
    assert {r.i: r.story for r in boilerplate.story_of_texts(df, "t", "h", known, shapes, ["i"]).collect()} == {1: [STORY.format("c"), STORY.format("d")], 2: [], 3: [], 4: []}
    assert boilerplate.winning_paths(read.limit(0), "host").count() == 0
    assert boilerplate.story_shapes(stories.limit(0)) == {} and boilerplate.boilerplate_texts(stories.limit(0), "host").count() == 0


def test_long_frame_lines_are_judged_like_short_ones(spark):
    notice = "Bu sayt öz ziyarətçilərinə daha yaxşı xidmət göstərmək üçün " + "kuki fayllarından və bənzər vasitələrdən istifadə edir " * 8 + "və siz bununla razılaşırsınız."
    foot = "© 2020 Sayt, " + "bütün hüquqlar qanunla qorunur " * 20
    around = f"<div class=c><p>{notice}</p></div>" + PAGE.replace("© 2020 Sayt", foot)
    pages = [(i, "h", around.format(i, STORY.format("a" * i) + " " + STORY.format("x " * 90), STORY.format("b" * i))) for i in range(1, 9)]
    read = boilerplate.read_pages(spark.createDataFrame(pages, "i int, host string, html string"), "html", ["i", "host"])
    stories = boilerplate.with_story(read, boilerplate.winning_paths(read, "host"), "host")
    judge = boilerplate.TextJudge([(r.kind, r.text) for r in boilerplate.boilerplate_texts(stories, "host").collect()], boilerplate.story_shapes(stories))
    for line in (notice, foot.replace("2020", "1999")):
        assert judge.story("\n".join([STORY.format("c"), STORY.format("d"), line]), "B") == [STORY.format("c"), STORY.format("d")]


def test_a_dictionary_of_any_size(spark, monkeypatch):
    want = queries.p4_found(spark, "/root/testdata/sf0.01").collect()
    monkeypatch.setattr(queries, "MAX_BROADCAST_ROWS", 1)
    monkeypatch.setattr(boilerplate, "MAX_BROADCAST_ROWS", 1)
    got = queries.p4_found(spark, "/root/testdata/sf0.01").collect()
    assert sum(r.rec_kind == "articles" for r in want) > 0
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
