import re
from collections import Counter

import pytest

from presslake.llm import encoding

LETTERS = "abcdefghij"


def word(i):
    return "ş" + "".join(LETTERS[int(c)] for c in f"{i:04d}")


def test_every_text_is_in_the_dictionary(spark):
    rows = [(i, "tr", f"{word(i)} {word(i + 5000)}") for i in range(1000)]
    df = spark.createDataFrame(rows, "id int, lang string, t string")
    (made,) = encoding.train_dictionaries(df, "id", "lang", "t")
    assert [i for i, _, t in rows if t.encode() not in made] == []
    assert encoding.train_dictionaries(df.repartition(7), "id", "lang", "t") == [made]  # however rows are spread


@pytest.mark.parametrize("bounds", [{}, {"COUNT_LETTERS": 20, "COUNTS_HELD": 3, "PARTS": 2}])
def test_counts_against_brute_force(spark, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(encoding, name, value)
    texts = [("az", "bir iki üç\nbir iki 5 üç  dörd"), ("az", None), ("az", ""), ("ru", "и вот\tон и\xa0вот"), ("az", "bir iki\n\n"), ("de", "ein Text"), (None, "x y"), ("ru", "слово два")] * 30
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(texts)], "id int, lang string, t string").repartition(3)
    want = Counter()
    for lang, t in texts:
        for run in encoding._BREAK.split(t or "") if lang in encoding.LANGS else ():
            words = re.findall(r"[^\s]*[\t\xa0]|[^\s]*(?: |$)", run)  # each with what ends it
            plain = [w.rstrip(" ") for w in words]
            want.update((lang, 1, w) for w in plain if w)
            want.update((lang, 2, a + b) for a, b, w in zip(words, plain[1:], plain) if w and b)
    got = [((r.code, r.n_words, r.phrase), r.n) for r in encoding.phrase_counts(df, "lang", "t").collect()]
    assert len(got) == len(want) and dict(got) == want


def test_the_first_phrases_of_all_parts(spark, monkeypatch):
    monkeypatch.setattr(encoding, "DICT_PHRASES", 5)
    monkeypatch.setattr(encoding, "PARTS", 3)
    rows = [(i, "tr", "\n".join([word(i)] * (i + 1))) for i in range(40)]
    (made,) = encoding.train_dictionaries(spark.createDataFrame(rows, "id int, lang string, t string"), "id", "lang", "t")
    assert [i for i in range(40) if word(i).encode() in made] == [35, 36, 37, 38, 39]


def test_wrongly_decoded_phrases_are_not_learnt(spark):
    good = "çalışmalarını anlattı"
    once, twice = good.encode("cp1254").decode("latin-1"), good.encode().decode("cp1252", "ignore")
    rows = [(i, "tr", good if i % 3 else once if i % 2 else twice) for i in range(60)]
    (made,) = encoding.train_dictionaries(spark.createDataFrame(rows, "id int, lang string, t string"), "id", "lang", "t")
    assert good.encode() in made and once.encode() not in made and twice.encode() not in made


def test_frequent_short_pairs_come_before_rare_long_ones(spark, monkeypatch):
    monkeypatch.setattr(encoding, "DICT_BYTES", 64)
    lines = ["Bir · iki"] * 50 + ["uzunuzunuzunuzun başqabaşqabaşqabaşqa"] * 20  # most bytes in all, but fewer saved for each of its own
    df = spark.createDataFrame([(i, "az", t) for i, t in enumerate(lines)], "id int, lang string, t string")
    (made,) = encoding.train_dictionaries(df, "id", "lang", "t")
    assert "Bir · iki".encode() in made or ("Bir ·".encode() in made and "· iki".encode() in made)
