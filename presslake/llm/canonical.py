"""Freely typed values mapped to a reference list: a trie of entries and aliases searched by a Levenshtein automaton.

The automaton accepts all strings within a distance of the typed value, where an insertion, deletion, replacement or swap
of neighbours counts 1. It is run against the trie, so that branches no state survives on are never visited. The distance
allowed follows from the length of the alias. Alias paths of an entry are its names, their words in reverse order, its names
with and without the address ending that its other names have, and, read exactly and only where nothing else fits, every
beginning that no other entry shares. Every entry within reach is returned with its distance, the closest first.

Values and aliases are compared as keys: case, diacritics, spaces and punctuation are folded, and the ``Decorations`` that the
caller names (labels, addresses, words around a name, signs of a path) are taken off.

Defined results
    null, '' , a value without letters ......... no entries
    very long values ........................... read whole; without decorations longer than any alias: no entries
    ties in distance ........................... the lower entry id first
    empty reference list ....................... no entries for any value
    repeated rows, extra columns ............... kept; the result is a new column
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslake.session import ship

MAX_ENTRIES = 100_000
#: Least letters of a shortened value, and its least share of the alias.
PREFIX_LETTERS, PREFIX_SHARE = 3, 0.3
#: Distances by the length of the alias: under the first bound 0, under the second 1, else 2.
DISTANCE_BOUNDS = (4, 8)

_FOLD = str.maketrans({"ə": "e", "ı": "i", "ø": "o", "ё": "е", "й": "и", "ł": "l", "đ": "d"})


@dataclass(frozen=True)
class Decorations:
    """What may stand around a name: before it with a colon, as the head of an address, after it, and between steps of a path."""

    labels: tuple[str, ...] = ("mənbə", "menbe", "source", "источник", "kaynak")
    addresses: tuple[str, ...] = ("https://", "http://", "www.", "m.")
    tails: tuple[str, ...] = ("(rss)", "/", "xəbərləri", "xeberleri", "news", "новости", "haberleri")
    steps: str = "/»>|"


def key_of(value: str) -> str:
    """Letters and digits of a value, folded."""
    x = unicodedata.normalize("NFD", value.replace("I", "i").replace("İ", "i").lower().translate(_FOLD))
    return "".join(c for c in x.translate(_FOLD) if c.isalnum())


@lru_cache(maxsize=16)
def _patterns(d: Decorations) -> tuple[re.Pattern, re.Pattern, re.Pattern, re.Pattern]:
    any_of = lambda words: "|".join(map(re.escape, words)) or r"(?!)"
    word = [(r"\b" if t[0].isalnum() else "") + re.escape(t) for t in d.tails]
    return (
        re.compile(rf"^\s*(?:{any_of(d.labels)})\s*:\s*", re.I), re.compile(rf"^\s*(?:{any_of(d.addresses)})", re.I),
        re.compile(rf"\s*[–—-]?\s*(?:{'|'.join(word) or '(?!)'})\s*$", re.I), re.compile(f"[{re.escape(d.steps)}]" if d.steps else r"(?!)"),
    )


def _stripped(value: str, pattern: re.Pattern) -> str:
    """The value without all that the pattern takes off its ends, if anything is left."""
    while (x := pattern.sub("", value)) != value and x.strip():
        value = x
    return value


def bare(value: str, decorations: Decorations = Decorations()) -> str:  # noqa: B008
    """The value without decorations."""
    label, address, tail, step = _patterns(decorations)
    x = _stripped(_stripped(label.sub("", unicodedata.normalize("NFC", value)), address), tail)
    parts = [p for p in step.split(x) if p.strip()]
    return parts[-1] if len(parts) > 1 else x


def reach(length: int) -> int:
    return 0 if length < DISTANCE_BOUNDS[0] else 1 if length < DISTANCE_BOUNDS[1] else 2


class Trie:
    """Nodes as parallel lists: children by character, entries that end here, entries below, height below."""

    def __init__(self, aliases: Iterable[tuple[str, int]]):
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[set[int]] = [set()]
        self.below: list[set[int]] = [set()]
        self.longest = [0]
        for alias, entry in aliases:
            at = 0
            for k, c in enumerate(alias):
                self.below[at].add(entry)
                self.longest[at] = max(self.longest[at], len(alias))
                nxt = self.children[at].get(c)
                if nxt is None:
                    nxt = self.children[at][c] = len(self.children)
                    self.children.append({})
                    self.ends.append(set())
                    self.below.append(set())
                    self.longest.append(0)
                at = nxt
            self.ends[at].add(entry)
            self.below[at].add(entry)
            self.longest[at] = max(self.longest[at], len(alias))
        self.depth = max(self.longest, default=0)

    def search(self, word: str) -> dict[int, int]:
        """Least distance of every entry that has an alias within that alias's reach."""
        n, top, found = len(word), 2, {}
        # A state of the automaton: the distances of the alias read so far to every beginning of the word, cut at top + 1.
        start = tuple(min(i, top + 1) for i in range(n + 1))
        stack = [(0, start, None, "", 0)]
        while stack:
            node, row, before, last, depth = stack.pop()
            if row[n] <= reach(depth):
                for e in self.ends[node]:
                    found[e] = min(found.get(e, top + 1), row[n])
            for c, child in self.children[node].items():
                new = [min(depth + 1, top + 1)]
                for i in range(1, n + 1):
                    d = min(row[i] + 1, new[i - 1] + 1, row[i - 1] + (word[i - 1] != c))
                    if before is not None and i > 1 and word[i - 1] == last and word[i - 2] == c:
                        d = min(d, before[i - 2] + 1)
                    new.append(min(d, top + 1))
                if min(new) <= top or (before is not None and min(row) <= top):
                    stack.append((child, tuple(new), row, c, depth + 1))
        return found

    def shortened(self, word: str) -> set[int]:
        """The entry whose aliases alone the word begins, read along its alias path."""
        at = 0
        for c in word:
            at = self.children[at].get(c, -1)
            if at < 0:
                return set()
        return self.below[at] if len(self.below[at]) == 1 and len(word) >= max(PREFIX_LETTERS, PREFIX_SHARE * self.longest[at]) else set()


@lru_cache(maxsize=8)
def trie_of(entries: tuple[tuple[int, tuple[str, ...]], ...], decorations: Decorations = Decorations()) -> Trie:  # noqa: B008
    """Entries are (id, names). An address ending is what follows the last full stop of a name without spaces."""
    aliases = set()
    for entry, names in entries:
        endings = {m[1] for name in names if (m := re.search(r"^\S+(\.\w+)$", name))}
        for name in names:
            stem = re.sub(r"\.\w+$", "", name) if " " not in name else name
            for form in (name, bare(name, decorations), stem, " ".join(reversed(name.split())), *[stem + e for e in endings]):
                if k := key_of(form):
                    aliases.add((k, entry))
    return Trie(sorted(aliases))


def lookup(value: str, trie: Trie, decorations: Decorations = Decorations()) -> list[tuple[int, int]]:  # noqa: B008
    """(entry, distance) of every entry within reach, closest first; a shortened value has distance 0."""
    word = key_of(bare(value, decorations)) if value else ""
    if not word or word.isdigit() or len(word) > trie.depth + reach(trie.depth):
        return []
    found = trie.search(word) or dict.fromkeys(trie.shortened(word), 0)
    return sorted(found.items(), key=lambda x: (x[1], x[0]))


def with_matches(df: DataFrame, value: str, entries: list[tuple[int, tuple[str, ...]]], out: str = "matches", decorations: Decorations = Decorations()) -> DataFrame:  # noqa: B008
    """Add ``out``: array of (ref_id, distance), closest first, empty if nothing is within reach.

    ``entries`` is a small reference list (at most ``MAX_ENTRIES``), shipped to the workers as a trie. Rows are mapped where
    they are, without a shuffle; each worker remembers the values it has looked up, so that hot values cost one search.
    """
    if len(entries) > MAX_ENTRIES:
        raise ValueError(f"more than {MAX_ENTRIES} reference entries")
    ship(df.sparkSession)
    ref = tuple(sorted((int(i), tuple(n for n in names if n)) for i, names in entries))

    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        trie = trie_of(ref, decorations)
        cached = lru_cache(maxsize=200_000)(lambda v: [{"ref_id": e, "distance": d} for e, d in lookup(v, trie, decorations)])
        for values in batches:
            yield pd.Series([cached(v) if v else [] for v in values], dtype=object)

    match.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(match, "array<struct<ref_id:int,distance:int>>").asNondeterministic()  # evaluated once
    return df.withColumn(out, udf(F.col(value)))
