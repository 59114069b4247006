"""Text that was decoded with a wrong character encoding, found and restored by minimum description length.

Each line is a segment. Its candidate decodings are all texts reached by chains of at most ``MAX_STEPS`` steps, each of
which encodes the text with a legacy code page and decodes the bytes as UTF-8 or as another code page (the latter once in a
chain). Every candidate is compressed with a zstandard dictionary per language, and the chain with the least bytes, its own
cost included, is taken; the unchanged text is the chain of cost 0. The dictionaries come from exact counts of the words and
pairs of words in all labelled texts.

No line is kept from the compressor. A line whose letters beyond ASCII take under ``READABLE`` bytes each as it stands is only
compared with the decodings that keep most letters (``KEEPING`` steps, and all of UTF-8): a page that changes every letter
leaves text that no dictionary has parts of, which takes more than that (1.12 at least, in all pairs of Cyrillic pages).

Defined results
    null, '' or blank value ................ not affected
    U+FFFD anywhere in the value ........... affected, restored text null (bytes are lost)
    a tie between chains ................... the shorter chain, then the order of ``STEPS``; unchanged wins over all
    repeated rows, extra columns ........... kept; every row is judged by itself
"""

from __future__ import annotations

import codecs
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslake.session import bounded_rows, ship

MAX_STEPS = 3
#: Compression levels; the fine one is used where the coarse one leaves less than ``CLOSE`` bytes between chains.
LEVEL, FINE_LEVEL, CLOSE = 3, 19, 4
READABLE = 1.0
#: Text without this has no other decoding.
BEYOND_ASCII = r"[^\x00-\x7f]"
#: Bounds of the dictionaries: bytes of one, and words (and as many pairs of words) of a language that come into question for it.
DICT_BYTES, DICT_PHRASES = 64 * 1024, 8192
#: Bytes that a phrase of the dictionary takes where a text has it.
MATCH_BYTES = 3
#: Words of the text that a dictionary's entropy tables are fitted on, and of a line of it.
TYPICAL_WORDS, LINE_WORDS = 60_000, 15
#: Letters that a task counts at once, and pairs of words that it holds before it passes them on.
COUNT_LETTERS, COUNTS_HELD = 1_000_000, 200_000
#: Parts in which the phrases of a language are added up and ranked.
PARTS = 256
LANGS = ("az", "ru", "en", "tr")

# Code pages by script.
LATIN, CYRILLIC = ("cp1252", "latin-1", "cp1254"), ("cp1251", "koi8-r", "cp866", "iso8859-5", "mac-cyrillic")
#: (code page the text was read with, what its bytes really are, cost of the step in bytes)
STEPS = (
    *((page, "utf-8", 0.5 if page == "cp1254" else 0.25) for page in LATIN + CYRILLIC),
    ("cp1252", "cp1254", 0.25), ("latin-1", "cp1254", 0.25), ("cp1251", "cp1254", 3.0), ("cp1251", "cp1252", 3.0),
    *((page, real, 3.0) for page in LATIN + CYRILLIC[:-1] for real in CYRILLIC[:-1] if page != real),
    ("cp1252", "mac-cyrillic", 6.0), ("latin-1", "mac-cyrillic", 6.0), ("cp1251", "mac-cyrillic", 6.0), ("mac-cyrillic", "cp1251", 6.0),
)
#: Steps between pages that agree on most letters.
KEEPING = frozenset({("cp1252", "cp1254"), ("latin-1", "cp1254"), ("cp1251", "mac-cyrillic"), ("mac-cyrillic", "cp1251")})


def _table(page: str) -> str:
    """Decoding table of a code page; bytes it leaves open stand for the C1 controls, as lenient decoders have it."""
    return "".join(bytes([b]).decode(page, "ignore") or chr(b) for b in range(256))


_DECODE = {p: _table(p) for p in LATIN + CYRILLIC}
_ENCODE = {p: codecs.charmap_build(t) for p, t in _DECODE.items()}
_SINGLE = {p: [(real, cost) for page, real, cost in STEPS if page == p and real != "utf-8"] for p in _DECODE}
_UTF8_COST = {page: cost for page, real, cost in STEPS if real == "utf-8"}


def _class(chars: str) -> str:
    return "[" + "".join(sorted({f"\\U{ord(c):08x}" for c in chars})) + "]"


#: A lead byte of UTF-8 and a continuation byte, as each page shows them: text without it has no reading as UTF-8.
_AS_UTF8 = re.compile("|".join(_class(t[0xC2:0xF5]) + _class(t[0x80:0xC0]) for t in _DECODE.values()))
_FOREIGN = re.compile("[^\\x00-\\x7f" + _class("".join(t[128:] for t in _DECODE.values()))[1:])  # in no page at all
_LETTER = re.compile(r"[^\W\d_\x00-\x7f]")
_BREAK, _OTHER_SPACE = re.compile(r"[\d\n]+"), re.compile(r"([^\S \n])")
_OFFSETS = b"".join(n.to_bytes(4, "little") for n in (1, 4, 8))  # the end of a dictionary's entropy tables
#: Bytes that a control or a character which Unicode does not assign takes besides its own, and what one beyond the scripts of
#: the languages, signs and pictures takes: short words can be read as such by chance.
NO_TEXT, OTHER_SCRIPT = 8, 3
_NO_TEXT = regex.compile(r"[\p{Cc}\p{Cn}\p{Co}\p{Cs}--\t]", regex.V1)
_OTHER = re.compile("[^\\x00-\u017f\u018f\u0259\u0400-\u052f\u1e00-\u1eff\u2000-\u2bff\ufe0f\U0001f000-\U0001faff]")


def utf8_readings(text: str, foreign: bool | None = None) -> list[tuple[str, str]]:
    """(code page, text) of each page under which the text was UTF-8; ``foreign``: whether it is known to have characters of no page."""
    out = []
    if _AS_UTF8.search(text) and not (_FOREIGN.search(text) if foreign is None else foreign):
        for page, table in _ENCODE.items():
            try:
                out.append((page, codecs.charmap_encode(text, "strict", table)[0].decode("utf-8")))
            except UnicodeError:
                pass
    return out


def candidates(text: str, whole: bool = True) -> list[tuple[float, str]]:
    """(cost, text) of every chain, the unchanged text first; without ``whole`` only ``KEEPING`` steps between single-byte pages."""
    found = {text: 0.0}
    front = [(text, False, bool(_FOREIGN.search(text)))]
    for _ in range(MAX_STEPS):
        reached = []
        for t, single, foreign in front:
            new = [(x, _UTF8_COST[page], single, bool(_FOREIGN.search(x))) for page, x in utf8_readings(t, foreign)]
            for page in _SINGLE if not single and not foreign else ():
                try:
                    raw = codecs.charmap_encode(t, "strict", _ENCODE[page])[0]
                except UnicodeError:
                    continue
                # What a page decodes has characters of that page only.
                new += [(codecs.charmap_decode(raw, "strict", _DECODE[real])[0], cost, True, False) for real, cost in _SINGLE[page] if whole or (page, real) in KEEPING]
            for x, cost, once, beyond in new:
                if x not in found:
                    found[x] = found[t] + cost
                    reached.append((x, once, beyond))
        if not reached:
            break
        front = reached
    return [(c, t) for t, c in found.items()]


@lru_cache(maxsize=4)
def _compressors(dicts: tuple[bytes, ...]) -> list[list[zstandard.ZstdCompressor]]:
    """Compressors by language, once for each of the two levels."""
    out = []
    for level in (LEVEL, FINE_LEVEL):
        params = zstandard.ZstdCompressionParameters.from_level(level, write_checksum=0, write_content_size=0, write_dict_id=0)
        out.append([])
        for d in dicts:
            z = zstandard.ZstdCompressionDict(d)
            z.precompute_compress(compression_params=params)
            out[-1].append(zstandard.ZstdCompressor(dict_data=z, compression_params=params))
    return out


def description_length(text: str, compressors: list[zstandard.ZstdCompressor]) -> int:
    raws = [text.encode("utf-8", "surrogatepass")]
    if text.isupper():  # the dictionaries hold few lines in capitals
        raws.append(text.lower().encode("utf-8", "surrogatepass"))
    odd = 0 if text.isprintable() else NO_TEXT * len(_NO_TEXT.findall(text))
    odd += OTHER_SCRIPT * len(_OTHER.findall(text))
    return odd + (min(len(c.compress(raw)) + 2 * i for i, raw in enumerate(raws) for c in compressors) if compressors else len(raws[0]))


def shortest(every: list[tuple[float, str]], compressors: list[list[zstandard.ZstdCompressor]], unchanged: int) -> str:
    """The text of the chain with the least description length, that of the first being known; the earlier one on a tie."""
    total = [unchanged, *(description_length(t, compressors[0]) + cost for cost, t in every[1:])]
    near = [i for i, n in enumerate(total) if n < min(total) + CLOSE]
    if len(near) > 1:  # decided by the fine level
        total = [description_length(every[i][1], compressors[1]) + every[i][0] if i in near else float("inf") for i in range(len(every))]
    return every[min(range(len(every)), key=total.__getitem__)][1]


def repair_line(line: str, compressors: list[list[zstandard.ZstdCompressor]]) -> str:
    """The line as it was meant."""
    if line.isascii() or _FOREIGN.search(line):
        return line
    length = description_length(line, compressors[0])
    every = candidates(line, length >= READABLE * len(_LETTER.findall(line)))
    return shortest(every, compressors, length) if len(every) > 1 else line


def repair(value: str, compressors: list[list[zstandard.ZstdCompressor]], line_of: Callable[[str], str] | None = None) -> str | None:
    """The restored value; None if no line is affected."""
    line_of = line_of or (lambda x: repair_line(x, compressors))
    lines = value.split("\n")
    fixed = [line_of(x) for x in lines]
    return "\n".join(fixed) if fixed != lines else None


def phrase_counts(texts: DataFrame, lang: str, text: str) -> DataFrame:
    """(code, n_words, part, phrase, n): how often each word and each two words in a row occur in all texts of a language.

    Words end at spaces, line ends and digits, or with other white space; that or a single space joins two of them. Tasks pass on
    what they hold in parts.
    The result is spread by ``part``, one of ``PARTS`` by the hash of the phrase.
    """
    ship(texts.sparkSession)

    def passed_on(code: str, counts: tuple[Counter, Counter]) -> Iterator[pa.RecordBatch]:
        for w in ("", "\n"):
            counts[0].pop(w, None)
        pairs = {(a if a[-1].isspace() else a + " ") + b: n for (a, b), n in counts[1].items() if a and b and a != "\n" and b != "\n"}
        for n_words, held in ((1, counts[0]), (2, pairs)):
            columns = [pa.repeat(code, len(held)), pa.repeat(pa.scalar(n_words, pa.int32()), len(held)), pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["code", "n_words", "phrase", "n"])
        for c in counts:
            c.clear()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[str]] = {code: [] for code in LANGS}
        letters = dict.fromkeys(LANGS, 0)
        counts: dict[str, tuple[Counter, Counter]] = {code: (Counter(), Counter()) for code in LANGS}

        def take(code: str) -> None:
            words = _OTHER_SPACE.sub(r"\1 ", _BREAK.sub(" \n ", "\n".join(waiting[code]))).split(" ")
            counts[code][0].update(words)
            counts[code][1].update(pairwise(words))
            waiting[code].clear()
            letters[code] = 0

        for batch in batches:
            for code, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                waiting[code].append(t)
                letters[code] += len(t)
                if letters[code] >= COUNT_LETTERS:
                    take(code)
                    if len(counts[code][1]) >= COUNTS_HELD:
                        yield from passed_on(code, counts[code])
        for code in LANGS:
            take(code)
            yield from passed_on(code, counts[code])

    known = texts.where(F.col(lang).isin(*LANGS) & F.col(text).isNotNull()).select(F.col(lang).alias("code"), F.col(text).alias("text"))
    held = known.mapInArrow(count, "code string, n_words int, phrase string, n bigint").withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).cast("int"))
    return held.repartition("code", "n_words", "part").groupBy("code", "n_words", "part", "phrase").agg(F.sum("n").alias("n"))


def is_clean(phrase: str, n: int, total: Counter) -> bool:
    """Whether a phrase found ``n`` times is as it was meant: it has no reading as UTF-8, and no other one that is more frequent."""
    if phrase.isascii():
        return True
    lower = phrase.lower()  # pages that differ in capitals only are no other reading
    return "�" not in phrase and not utf8_readings(phrase) and all(total[t] <= n or t.lower() == lower for _, t in candidates(phrase))


def typical_lines(words: list[tuple[str, int]]) -> list[bytes]:
    """Lines of ``TYPICAL_WORDS`` words, or of as many as there are, in which each word has the share that it has in all texts."""
    total, done, out = sum(n for _, n in words), 0, []
    size = min(total, TYPICAL_WORDS)
    for word, n in words:
        done += n
        out += [word] * (done * size // total - len(out))
    n_lines = -(-size // LINE_WORDS)
    return [" ".join(out[i::n_lines]).encode("utf-8", "surrogatepass") for i in range(n_lines)]


def dictionary_of(phrases: list[str], words: list[tuple[str, int]]) -> bytes:
    """A zstandard dictionary: entropy tables fitted on typical lines, then the phrases, the first ones nearest to the text."""
    content = " ".join(reversed(phrases)).encode("utf-8", "surrogatepass")
    try:
        trained = zstandard.train_dictionary(DICT_BYTES, typical_lines(words), k=200, d=8, level=LEVEL).as_bytes()
        tables = trained[: trained.index(_OFFSETS) + len(_OFFSETS)]
    except zstandard.ZstdError:  # too few words to fit tables on
        tables = b""
    return tables + content[len(tables) - DICT_BYTES :]


def train_dictionaries(texts: DataFrame, key: str, lang: str, text: str) -> list[bytes]:
    """One zstandard dictionary per language, of the words and pairs of words that save most bytes of all its texts for each of their own.

    Every text is counted, so no ``key`` has to be chosen. Counts are exact and don't depend on how rows are spread.
    """
    size = F.octet_length("phrase")
    ranked = phrase_counts(texts, lang, text).withColumn("saved", F.col("n") * F.greatest(size - MATCH_BYTES, F.lit(0)) / size)
    for within in (["code", "n_words", "part"], ["code", "n_words"]):  # the first of all parts are among the first of each
        place = F.row_number().over(Window.partitionBy(*within).orderBy(F.col("saved").desc(), "phrase"))
        ranked = ranked.withColumn("place", place).where(F.col("place") <= DICT_PHRASES)
    rows = sorted(bounded_rows(ranked, 2 * DICT_PHRASES * len(LANGS), "phrases"), key=lambda r: (-r.saved, r.phrase))
    total: Counter = Counter()
    for r in rows:
        total[r.phrase] += r.n
    out = []
    for code in LANGS:
        phrases, words, left = [], [], DICT_BYTES
        for r in rows:
            if r.code == code and (left > 0 or r.n_words == 1) and is_clean(r.phrase, r.n, total):
                if left > 0:
                    phrases.append(r.phrase)
                    left -= len(r.phrase.encode("utf-8", "surrogatepass")) + 1
                if r.n_words == 1:
                    words.append((r.phrase, r.n))
        out.append(dictionary_of(phrases, words))
    return [d for d in out if len(d) >= 8]


def repair_encoding(df: DataFrame, value: str, dictionaries: list[bytes], affected: str = "affected", restored: str = "restored") -> DataFrame:
    """Add ``affected`` (boolean) and ``restored`` (text, null where unaffected or lost) for the column ``value``."""
    ship(df.sparkSession)
    dicts = tuple(dictionaries)

    def fix(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        compressors = _compressors(dicts)
        line_of = lru_cache(maxsize=100_000)(lambda x: repair_line(x, compressors))
        for values in batches:
            yield pd.Series([repair(v, compressors, line_of) if v else None for v in values], dtype=object)

    fix.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(fix, "string").asNondeterministic()  # else a filter on the result evaluates it again
    v: Column = F.col(value)
    lost = v.contains("�")
    return df.withColumn(restored, udf(F.when(v.rlike(BEYOND_ASCII) & ~lost, v))).withColumn(affected, F.coalesce(lost | F.col(restored).isNotNull(), F.lit(False)))
