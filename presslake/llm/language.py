"""Language of documents and of their stretches, by cross-parsing with suffix automata.

A suffix automaton per model (a language in one script) holds running text of a labelled sample. A line is parsed from left to
right, across its words, into the fewest longest matches with the automaton; its score in a model is the number of these
phrases, normalised by its letters. The model that needs the fewest wins. The automata are tables of transitions, and all lines
of a batch are parsed abreast, one letter a step.

Lines are joined into stretches: of all ways to give the lines of a text languages, the one that needs the fewest phrases is
taken, where each change of language counts as ``CHANGE`` phrases. Lines without words to judge (links, tags, numbers), and
those that no model reads (codes), belong to the stretch around them. The confidence of a stretch is 1 less the phrases that
it needs over those of the second best language.

Defined results
    null, empty or blank text ............... no stretches
    under ``MIN_WORDS`` words ............... stretches are given, but the record is too short to judge its label
    only links, tags, numbers ............... no stretches
    names ................................... parsed like other words; no model has their parts, so they decide nothing
    very long lines ......................... parsed whole, in pieces of ``PIECE`` letters
    no labelled text ........................ no stretches for any record
    ties .................................... the first model in order of name
    repeated keys ........................... judged one by one
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslake.llm.encoding import candidates, utf8_readings
from presslake.session import bounded_rows, checkpointed, ship

LANGS = ("az", "ru", "en", "tr")
MIN_WORDS = 5
#: Bound of the labelled sample: texts per model, and letters of running text in an automaton.
SAMPLE_TEXTS, MODEL_LETTERS = 200, 40_000
#: Phrases that a change of language counts, and phrases a letter above which a line is in no language that a model has.
CHANGE, NO_LANGUAGE = 5.0, 0.55
#: Lines are parsed in pieces of so many letters, and so many pieces abreast.
PIECE, ABREAST = 512, 8192
#: Phrases a letter above which a line is tried in other decodings, and by how many a reading must be better.
UNREADABLE, WORTH_IT = 0.3, 0.1

# Codes of the languages.
CODES = {"az": "az", "aze": "az", "azb": "az", "azj": "az", "ru": "ru", "rus": "ru", "en": "en", "eng": "en", "tr": "tr", "tur": "tr"}

_WORD = re.compile(r"[^\W\d_]+(?:[’'-][^\W\d_]+)*")
_NOISE = re.compile(r"\w+://\S+|www\.\S+|\S+@\S+|[#@]\w+|\b[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}\b")
_MAY_BE_NOISE = re.compile(r"[#@]|://|www\.|\.[A-Za-z]")
_TURKIC = re.compile("[əışğƏŞĞ]")
_CYRILLIC = re.compile("[Ѐ-ӿ]")


class SuffixAutomaton:
    """Recognises every substring of the text it is built from."""

    def __init__(self, text: str):
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur

    def phrases(self, word: str) -> int:
        """Longest matches that a left-to-right parse of the word needs; an unknown character is a phrase of its own."""
        n, at, count = len(word), 0, 0
        while at < n:
            state, start = 0, at
            while at < n and (nxt := self.next[state].get(word[at])) is not None:
                state = nxt
                at += 1
            at += at == start
            count += 1
        return count


def fold(line: str) -> str:
    """Lower case; the capital I is dotless where the line has letters that only the Turkic alphabets have."""
    line = line.replace("İ", "i")
    if "I" in line:
        line = line.replace("I", "ı" if _TURKIC.search(line) else "i")
    return line.lower()


class Scorer:
    """Phrase counts of lines under every model."""

    def __init__(self, models: tuple[tuple[str, str], ...]):
        self.names = [m for m, _ in models]
        self.langs = [m.split("_")[0] for m in self.names]
        self.nothing = np.zeros(len(models))
        letters = sorted(set("".join(t for _, t in models)))
        self.code = np.zeros(0x3000, np.uint8)  # 0: a letter that no model has
        self.code[[ord(c) for c in letters if ord(c) < 0x3000][:254]] = np.arange(1, 1 + min(len(letters), 254))
        self.width = int(self.code.max()) + 1
        self.tables = []
        for _, t in models:
            automaton = SuffixAutomaton(t)
            table = np.zeros((len(automaton.next), self.width), np.int32)
            state = np.repeat(np.arange(len(automaton.next)), [len(n) for n in automaton.next])
            sign = self.code[[min(ord(c), 0x2FFF) for n in automaton.next for c in n]]
            table[state, sign] = [x for n in automaton.next for x in n.values()]
            table[:, 0] = 0
            self.tables.append(table.ravel())

    def phrases(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Phrases that each piece (codes of its letters) needs under each model, one row a piece."""
        out = np.zeros((len(pieces), len(self.tables)), np.int32)
        order = np.argsort([-len(p) for p in pieces], kind="stable")
        for at in range(0, len(order), ABREAST):
            some = order[at : at + ABREAST]
            sizes = np.array([len(pieces[i]) for i in some])
            steps = np.zeros((int(sizes[0]), len(some)), np.uint8)  # a row for each place, longest pieces first
            for k, i in enumerate(some):
                steps[: sizes[k], k] = pieces[i]
            active = np.searchsorted(-sizes, -np.arange(len(steps)), side="left")  # pieces longer than the place
            for m, table in enumerate(self.tables):
                state, count, root = np.zeros(len(some), np.int32), np.zeros(len(some), np.int32), table[: self.width]
                for sign, n in zip(steps, active):
                    s, c = state[:n], sign[:n]
                    following = table[s * self.width + c]
                    missed = following == 0
                    # A match ends where it has no next letter, which begins the next match; an unknown one is a phrase of its own.
                    again = root[c]
                    count[:n] += missed & (s != 0)
                    count[:n] += missed & (again == 0)
                    state[:n] = np.where(missed, again, following)
                out[some, m] = count + (state != 0)
        return out

    def lines(self, lines: list[str]) -> list[tuple[int, np.ndarray] | None]:
        """(letters, phrases by model) of each line; None if it has nothing to judge."""
        out: list[tuple[int, np.ndarray] | None] = [None] * len(lines)
        pieces, owner, letters = [], [], np.zeros(len(lines), int)
        for i, line in enumerate(lines):
            found = _WORD.findall(_NOISE.sub(" ", line) if _MAY_BE_NOISE.search(line) else line)
            if not found:
                continue
            letters[i] = sum(map(len, found))
            text = np.frombuffer(fold(f" {' '.join(found)} ").encode("utf-32-le"), np.uint32)
            codes = self.code[np.minimum(text, 0x2FFF)]
            for at in range(0, len(codes), PIECE):
                pieces.append(codes[at : at + PIECE])
                owner.append(i)
        if pieces:
            total = np.zeros((len(lines), len(self.tables)), np.int64)
            np.add.at(total, owner, self.phrases(pieces))
            for i in np.flatnonzero(letters):
                out[i] = int(letters[i]), total[i]
        return out

    def judged(self, lines: list[str]) -> list[tuple[int, np.ndarray] | None]:
        """``lines``, where wrongly decoded text is taken in the reading that needs the fewest phrases."""
        out = self.lines(lines)
        score = lambda x: x[1].min() / x[0]
        again = [(i, t) for i, line in enumerate(lines) if not line.isascii() and (out[i] is None or score(out[i]) > UNREADABLE) for t in dict.fromkeys(t for _, t in candidates(line)[1:])]
        for (i, _), other in zip(again, self.lines([t for _, t in again])):
            if other is not None and (out[i] is None or score(other) < score(out[i]) - WORTH_IT):
                out[i] = other
        return out

    def stretches(self, texts: list[str]) -> list[tuple[int, list[tuple[str, float]]]]:
        """(words, [(language, confidence)]) of each text, with one entry per stretch."""
        split = [[x for x in (t or "").split("\n") if x.strip()] for t in texts]
        place: dict[str, int] = {}
        for lines in split:
            for x in lines:
                place.setdefault(x, len(place))
        judged = self.judged(list(place))
        langs = sorted(set(self.langs))
        phrases = np.array([j[1] if j else self.nothing for j in judged], float).reshape(len(judged), len(self.langs))
        need = np.stack([phrases[:, [i for i, x in enumerate(self.langs) if x == lang]].min(1) for lang in langs], axis=1)
        letters = np.array([j[0] if j else 0 for j in judged], float)
        readable = (letters > 0) & (need.min(1, initial=np.inf) <= NO_LANGUAGE * letters)
        out = []
        for lines in split:
            rows = np.array([place[x] for x in lines], int)
            rows = rows[readable[rows]]
            out.append((sum(len(x.split()) for x in lines), self._runs(need[rows], langs) if len(rows) else []))
        return out

    @staticmethod
    def _runs(need: np.ndarray, langs: list[str]) -> list[tuple[str, float]]:
        """The languages of the lines that need the fewest phrases altogether, where a change of language counts ``CHANGE``."""
        path = need.argmin(1)
        if (path != path[0]).any():
            cost, back = need[0], []
            for row in need[1:]:
                least = cost.min() + CHANGE
                back.append(np.where(cost <= least, np.arange(len(langs)), cost.argmin()))
                cost = np.minimum(cost, least) + row
            path = [int(cost.argmin())]
            for step in reversed(back):
                path.append(int(step[path[-1]]))
            path = np.array(path[::-1])
        starts = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
        out = []
        for k, row in zip(path[starts], np.add.reduceat(need, starts, axis=0)):
            other = np.delete(row, k).min(initial=np.inf)
            out.append((langs[k], 1.0 if other == np.inf else round(float(max(0.0, 1 - row[k] / other)), 4) if other else 0.0))
        return out


@lru_cache(maxsize=4)
def scorer_of(models: tuple[tuple[str, str], ...]) -> Scorer:
    return Scorer(models)


def language_of_label(label: Column) -> Column:
    """The language that a label names, null if it names none: two or three letters in any case, with or without region."""
    code = F.lower(F.regexp_extract(F.trim(label), r"^([A-Za-z]{2,3})(?:[-_][A-Za-z0-9]+)*$", 1))
    return F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])[code]


def train_models(labelled: DataFrame, key: str, lang: str, text: str, labels: DataFrame | None = None) -> tuple[tuple[str, str], ...]:
    """Models (name, running text) from at most ``SAMPLE_TEXTS`` texts per language and script, chosen by hash of ``key``.

    The labels stand beside the texts, or in a table of their own (``key``, ``lang``), which no text is moved to meet. Keys and labels are gathered in one scan, the texts of the chosen in another. Lines that the other models explain better
    than their label's are then left out, so that wrong labels and foreign passages do not teach a language the words of another.
    """
    rows: dict[str, list[str]] = {}
    script = F.col(text).rlike("[әҹҝғһө]").alias("cyrl")
    tagged = labelled.select(key, lang, script) if labels is None else labelled.select(key, script).join(labels.select(key, lang), key)
    model = F.concat(lang, F.when((F.col(lang) == "az") & F.col("cyrl"), "_cyrl").otherwise("_main"))
    tagged = checkpointed(tagged.where(F.col(lang).isin(*LANGS)).select(key, model.alias("model"), F.xxhash64(key).alias("h")))
    ranked = None
    for name in ("az_main", "az_cyrl", "ru_main", "en_main", "tr_main"):
        part = tagged.where(F.col("model") == name).orderBy("h", key).limit(SAMPLE_TEXTS)
        ranked = part if ranked is None else ranked.unionByName(part)
    chosen = {r[key]: r.model for r in bounded_rows(ranked, SAMPLE_TEXTS * (len(LANGS) + 1), "sample keys")}
    if not chosen:
        return ()
    for r in bounded_rows(labelled.where(F.col(key).isin(list(chosen))).select(key, text), 4 * len(chosen) + 1000, "sample texts"):
        rows.setdefault(chosen[r[key]], []).extend(x for x in (r[text] or "").split("\n") if x.strip() and "�" not in x and not utf8_readings(x))
    # An outlier of script is foreign to its language, whatever its label.
    for m in rows:
        wants = m in ("ru_main", "az_cyrl")
        rows[m] = sorted({x for x in rows[m] if bool(_CYRILLIC.search(x)) == wants}, key=lambda x: (zlib.crc32(x.encode()), x))
    words = lambda line: {fold(w) for w in _WORD.findall(_NOISE.sub(" ", line)) if w[0].islower()}
    # Words by the number of lines that have them: a foreign line's words are rare under a wrong label.
    share: dict[str, dict[str, float]] = {}
    for m, lines in rows.items():
        counts: dict[str, int] = {}
        for x in lines:
            for w in words(x):
                counts[w] = counts.get(w, 0) + 1
        share[m] = {w: c / max(len(lines), 1) for w, c in counts.items()}
    models = []
    for m, lines in sorted(rows.items()):
        running, size = [], 0
        for x in lines:
            own = words(x)
            if size < MODEL_LETTERS and own and sum(share[m][w] for w in own) >= max((sum(share[o].get(w, 0.0) for w in own) for o in share if o != m), default=0.0):
                running.append(fold(" ".join(_WORD.findall(_NOISE.sub(" ", x)))))
                size += len(running[-1])
        if running:
            models.append((m, " " + " \n ".join(running)[:MODEL_LETTERS] + " "))
    return tuple(models)


def label_stretches(df: DataFrame, text: str, models: tuple[tuple[str, str], ...], keep: list[str]) -> DataFrame:
    """(keep..., n_words, stretches array<struct<lang, confidence>>): the columns ``keep`` must not be named like these."""
    ship(df.sparkSession)

    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = scorer_of(models)
        for values in batches:
            done = scorer.stretches(list(values)) if models else [(0, [])] * len(values)
            yield pd.DataFrame({"n_words": [n for n, _ in done], "stretches": [[{"lang": a, "confidence": c} for a, c in s] for _, s in done]})

    judge.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    udf = F.pandas_udf(judge, "n_words int, stretches array<struct<lang:string,confidence:double>>").asNondeterministic()
    return df.select(*keep, udf(F.col(text)).alias("j")).select(*keep, "j.n_words", "j.stretches")
