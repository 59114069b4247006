import random
from collections import Counter

import numpy as np
import pytest

from presslake.llm import mixing, neardup, tokenizer, truncation


def texts(n, seed=1):
    r = random.Random(seed)
    vocabulary = [f"söz{i}" for i in range(400)]
    base = [[r.choice(vocabulary) for _ in range(r.randint(40, 90))] for _ in range(n)]
    out = [" ".join(b) for b in base]
    for b in base[: n // 2]:
        c = list(b)
        at, k = r.randrange(len(c)), r.randint(1, len(b) // 7)  # one passage is replaced, another moved
        c[at : at + k] = [f"yeni{r.randrange(9999)}" for _ in range(k)]
        cut = r.randrange(len(c))
        out.append("\n".join([" ".join(c[cut:]), " ".join(c[:cut])]))
    return out


def brute(rows):
    found = set()
    for i, (ka, a) in enumerate(rows):
        for kb, b in rows[i + 1 :]:
            if a and b and "�" not in a + b:
                x, y = Counter(a.split()), Counter(b.split())
                if min(x.total(), y.total()) >= 30 and sum((x & y).values()) >= 0.8 * max(x.total(), y.total()):
                    found.add((min(ka, kb), max(ka, kb)))
    return found


def test_near_duplicates_against_brute_force(spark):
    t = texts(60)
    rows = [(f"k{i}", x) for i, x in enumerate(t)] + [("copy1", t[0]), ("copy2", t[0]), ("null", None), ("empty", ""), ("lost", t[1] + " �"), ("short", "bir iki"), ("long", t[2] + " uzun" * 20_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "key string, text string, rep int").repartition(5)
    got = [(r.key_a, r.key_b) for r in neardup.similar_pairs(df).collect()]
    assert len(got) == len(set(got))
    want = brute(rows)
    assert set(got) <= want and len(got) >= 0.98 * len(want)
    classes = {r.key: r for r in neardup.classes_with_links(df).collect()}
    assert classes["copy1"].class_key == classes["copy2"].class_key == classes["k0"].class_key and classes["copy1"].n_copies == 3 and classes["copy1"].n_links >= 1
    assert neardup.similar_pairs(df.limit(0)).count() == 0


def test_scattered_edits_are_found(spark):
    rows = []
    for i in range(12):  # every fifth word replaced: no shingle of five words in common
        a = [f"a{i}x{k}" for k in range(40 + 50 * i)]
        rows += [(f"p{i}", " ".join(a)), (f"q{i}", " ".join(f"new{i}x{k}" if k % 5 == 4 else w for k, w in enumerate(a)))]
    got = {(r.key_a, r.key_b) for r in neardup.similar_pairs(spark.createDataFrame(rows, "key string, text string")).collect()}
    assert got == brute(rows) == {(f"p{i}", f"q{i}") for i in range(12)}


def test_every_record_has_a_class(spark):
    whole = " ".join(f"w{k}" for k in range(40))
    rows = [("a", whole), ("b", whole), ("null1", None), ("null2", None), ("empty1", ""), ("empty2", ""), ("s1", "bir iki"), ("s2", "bir iki"), ("s3", "üç"), ("lost", whole + " �"), ("x", "a b " * 20)]
    got = sorted((r.key, r.class_key, r.n_copies, r.n_links) for r in neardup.classes_with_links(spark.createDataFrame(rows, "key string, text string")).collect())
    alone = [(k, k, 1, 0) for k in ("empty1", "empty2", "lost", "null1", "null2", "s3", "x")]
    assert got == sorted([("a", "a", 2, 0), ("b", "a", 2, 0), ("s1", "s1", 2, 0), ("s2", "s1", 2, 0), *alone])


def test_bit_sliced_distances_equal_plain_ones():
    r = np.random.default_rng(3)
    for n, density in ((5, 0.5), (700, 0.5), (1500, 0.03)):
        bits = (r.random((n, neardup.BITS)) < density).astype(np.uint8)
        planes = np.packbits(bits.T, axis=1)
        for shift in (1, 3, 8, 13):
            m = n - shift
            if m <= 0:
                continue
            plain = (bits[:m] ^ bits[shift:]).sum(1)
            got = neardup.distances(planes, shift, m, np.full(m, neardup.BITS))
            assert (got == plain).all()
            near = neardup.distances(planes, shift, m, np.full(m, 40))
            assert ((near <= 40) == (plain <= 40)).all()


@pytest.mark.parametrize("sample", [64, 1])  # with 1, every bucket of two or more is hot
def test_buckets_larger_than_a_block_and_hot_ones_lose_nothing(spark, monkeypatch, sample):
    for name, value in (("BLOCK", 7), ("SAMPLE", sample), ("HOT_IN_SAMPLE", 2), ("PART", 2)):
        monkeypatch.setattr(neardup, name, value)
    base = [f"w{i}" for i in range(60)]
    rows = [(f"k{i:02d}", " ".join(base[:-1] + [f"x{i}"])) for i in range(40)]
    rows += [(f"m{i:02d}", " ".join([*base, *[f"y{i}z{k}" for k in range(i)]])) for i in range(14)]  # lengths over a class of lengths
    rows += [(f"c{i}", rows[3][1]) for i in range(5)]
    got = [(r.key_a, r.key_b) for r in neardup.similar_pairs(spark.createDataFrame(rows, "key string, text string")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


@pytest.mark.parametrize("n", [30, 60, 200, 1000])
@pytest.mark.parametrize(("similarity", "least"), [(0.8, 0.99), (0.85, 1), (0.9, 1)])
def test_bands_find_edits_of_every_kind(n, similarity, least):
    r = np.random.default_rng(n)
    shared, found, tried = int(np.ceil(similarity * n)), 0, 0
    for _ in range(100):
        words = r.integers(1, 2**63, n, dtype=np.uint64)
        fresh = r.integers(1, 2**63, n, dtype=np.uint64)
        keep = r.permutation(n) < shared  # random places
        even = np.arange(n) * shared // n != (np.arange(n) + 1) * shared // n
        block = np.arange(n) < shared
        for kept in (keep, even, block):
            other = np.where(kept, words, fresh)
            for text in (other, words[kept]):  # replaced or left out
                found += (neardup.sketch(words)[2] == neardup.sketch(text)[2]).any()
                tried += 1
    assert found >= least * tried


def test_sketch_distance_is_a_lower_bound():
    r = random.Random(5)
    for _ in range(50):
        a = [r.randrange(90) for _ in range(120)]
        b = a[:80] + [r.randrange(90) for _ in range(40)]
        x, y = Counter(a), Counter(b)
        odd = [np.unpackbits(np.frombuffer(neardup.sketch(np.array(t, np.uint64))[1], np.uint8)) for t in (a, b)]
        assert (odd[0] ^ odd[1]).sum() <= ((x - y) + (y - x)).total()


TEXTS = [None, "", " ", "Hello  world's\n\n ok", "Şəhərdə 123 qəza", "Привет, мир!", "日本語 🇦🇿 x y", "<|endoftext|> a", "a" * 300, "\t\n 　 z", "don't we'll I'M", "café"]


def test_tokens_equal_the_public_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(f"{tokenizer.TOKENIZER_DIR}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    df = spark.createDataFrame([(i, x, 5) for i, x in enumerate(TEXTS)], "id int, t string, ids int")
    ids = tokenizer.encode_texts(df, "id", "t")
    got = {r.id: r.ids for r in ids.collect()}
    assert got == {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(TEXTS)}
    assert {r.id: r.decoded for r in tokenizer.decode_ids(ids, "ids").collect()} == {i: x or "" for i, x in enumerate(TEXTS)}
    assert tokenizer.encode_texts(df.limit(0), "id", "t").count() == 0


def test_rare_words_take_the_other_way(spark, monkeypatch):
    monkeypatch.setattr(tokenizer, "COMMON_WORDS", 2)
    df = spark.createDataFrame([(1, "bir iki üç dörd bir"), (2, None)], "id int, t string")
    got = {r.id: r.ids for r in tokenizer.encode_texts(df, "id", "t").collect()}
    back = {r.id: r.decoded for r in tokenizer.decode_ids(spark.createDataFrame(list(got.items()), "id int, ids array<int>"), "ids").collect()}
    assert back == {1: "bir iki üç dörd bir", 2: ""}


def test_pfair_deviates_less_than_one_block():
    w = {"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05}
    plan = mixing.pfair_schedule(w, 1000)
    assert [s for s, _, _ in plan] == list(range(1000))
    n = Counter()
    for slot, s, j in plan:
        assert j == n[s]
        n[s] += 1
        assert all(abs(n[x] - w[x] * (slot + 1)) < 1 for x in w)


def test_mix(spark):
    docs = [(i, "a", 10) for i in range(300)] + [(1000 + i, "b", 7) for i in range(40)] + [(5000, "b", None), (5001, "b", 0), (5002, "z", 9), (5003, None, 9)]
    df = spark.createDataFrame(docs, "id int, source string, n int")
    targets = spark.createDataFrame([("a", 0.7, 1), ("b", 0.2, 3), ("gone", 0.1, 4)], "source string, target_share double, max_repeats int")
    selection, shares = mixing.mix_sources(df, targets, "id", "source", "n")
    rows = selection.collect()
    uses = Counter(r.id for r in rows)
    assert max(v for k, v in uses.items() if k < 1000) == 1 and max(uses.values()) <= 3 and not {5000, 5001, 5002, 5003} & set(uses)
    got = {r.source: r for r in shares.collect()}
    assert abs(got["a"].actual_share - 7 / 9) < 0.01 and abs(got["b"].actual_share - 2 / 9) < 0.01 and got["gone"].n_uses == 0
    total, seen = sum(r["size"] for r in rows), Counter()
    done = 0
    for r in sorted(rows, key=lambda r: (r.slot, r.place)):
        done += r["size"]
        seen[r.source] += r["size"]
        assert abs(seen["a"] - 7 / 9 * done) < total / mixing.SLOTS + 2 * 10
    empty, none = mixing.mix_sources(df.limit(0), targets, "id", "source", "n")
    assert empty.count() == 0 and {r.actual_share for r in none.collect()} == {0.0}


def test_truncation(spark, monkeypatch):
    r = random.Random(2)
    words = "nazirlik verilən xəbərə əsasən şəhər istiqamətində hərəkət müvəqqəti məhdudlaşdırılıb görüşdə tərəflər əlaqələrin inkişafını müzakirə ediblər".split()
    sentence = lambda: " ".join(r.choice(words) for _ in range(9)).capitalize() + "."
    whole = ["\n\n".join(" ".join(sentence() for _ in range(3)) for _ in range(r.randint(3, 6))) for _ in range(400)]
    signed = [w + "\nVəyel Rusərov" for w in whole[:60]]
    cut = [w[:400].rstrip() if i % 2 else w[:400] + "…" for i, w in enumerate(whole[100:140]) if w[399] not in ". \n"]
    rows = [(i, "s", t, "T") for i, t in enumerate(whole + signed + cut)] + [(9000, "s", None, None), (9001, None, "", None), (9002, None, " \n", None)]
    df = spark.createDataFrame(rows, "id int, source string, t string, title string")
    scored = truncation.score_texts(df, "id", "source", "t", "title")
    got = {x.id: x.score for x in scored.collect()}
    assert len(got) == len(rows) and got[9000] is None and got[9001] is None and got[9002] is None
    first = len(whole) + len(signed)
    assert sum(got[i] > 0 for i in range(first, first + len(cut))) >= 0.95 * len(cut)
    assert sum(got[i] > 0 for i in range(first)) <= 0.02 * first
    assert {x.id for x in truncation.cut_off(scored).collect()} == {i for i, s in got.items() if s is not None and s > 0}
    assert truncation.truncation_rates(scored, "source").where("source = 's'").collect()[0].n_texts == first + len(cut)
    monkeypatch.setattr(truncation, "MAX_BROADCAST_ROWS", 0)  # limits that meet their texts in a shuffle
    assert {x.id: x.score for x in truncation.score_texts(df, "id", "source", "t", "title").collect()} == got
    assert truncation.score_texts(df.limit(0), "id", "source", "t", "title").count() == 0
