"""Evaluation passages leaking into texts: a generalised suffix automaton of the normalised test items.

The automaton is built over the words of all items, a separator between them.  Training words stream through it; at every
word the longest stretch that ends there and stands in some item is known.  Where it has ``STRETCH`` words or more, the state
of its last ``STRETCH`` words tells all places where those words stand in the items, and the words there are covered.  (All
stretches of at least STRETCH words are unions of such windows, so nothing is lost.)  An item leaks into a text if at least
``SHARE`` of its words are covered.

Spans are removed from the texts by two limits: a stretch of ``LONG`` words or more goes whatever its item, and all stretches
of an item go that leaks into the text.

The items are a fixed set; they are taken in blocks of at most ``BLOCK_WORDS`` words, so that what a task holds is bounded
also for a larger set.  The texts are read without shuffle, once for each block; what is removed, for all blocks at once.

Defined cases: null and empty texts hold no item; an item without words leaks nowhere; equal items both leak; case, accents,
punctuation, markup and spacing don't matter.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STRETCH = 4
#: A stretch of so many words is removed even if its item isn't covered further.
LONG = 12
SHARE = 0.5
BLOCK_WORDS = 200_000

_TAG = re.compile(r"<[^<>]*>")
_HIDDEN = re.compile("[­​-‏⁠﻿ـ]")
_WORD = re.compile(r"[^\W_]+")


def _repaired(text: str) -> str:
    """Text whose UTF-8 was once read as Windows-1252, read right again where that is possible."""
    def back(match: re.Match) -> str:
        try:
            return match[0].encode("cp1252").decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            return match[0]

    return re.sub("[ÃÂØÙ][\u0080-ÿŒ-™]|â[\u0080-ÿŒ-™€]{2}", back, text)


def normalised(text: str | None) -> list[str]:
    """The words of a text in the form in which they are compared."""
    if not text:
        return []
    if "Ã" in text or "â" in text or "Â" in text or "Ø" in text:
        text = _repaired(text)
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    if text.isascii():
        return _WORD.findall(text.lower())
    text = _HIDDEN.sub("", unicodedata.normalize("NFKD", text))
    if not text.isascii():
        text = "".join(c for c in text if not unicodedata.combining(c))
    return _WORD.findall(text.casefold())


class ItemAutomaton:
    """A generalised suffix automaton over words."""

    def __init__(self, items: list[tuple[int, list[str]]], stretch: int = STRETCH) -> None:
        self.items, self.stretch = items, stretch
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length = [-1], [0]
        first_end: list[list[tuple[int, int]]] = [[]]
        for n, (_, words) in enumerate(items):
            last = 0
            for at, word in enumerate(words):
                last = self._extend(last, word, first_end)
                first_end[last].append((n, at))
        # ends of a state are those of all states below it
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[state] > 0:
                first_end[self.link[state]] += first_end[state]
        self.ends = [sorted(set(e)) for e in first_end]
        self.window = [-1] * len(self.link)  # the state of the last `stretch` words
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            if self.length[state] >= stretch:
                above = self.link[state]
                self.window[state] = state if self.length[above] < stretch else self.window[above]

    def _new(self, length: int, edges: dict[str, int], link: int, ends: list) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        ends.append([])
        return len(self.next) - 1

    def _extend(self, last: int, word: str, ends: list) -> int:
        known = self.next[last].get(word)
        if known is not None and self.length[known] == self.length[last] + 1:
            return known
        if known is not None:
            return self._clone(last, word, known, ends)
        state, at = self._new(self.length[last] + 1, {}, 0, ends), last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            below = self.next[at][word]
            self.link[state] = below if self.length[below] == self.length[at] + 1 else self._clone(at, word, below, ends)
        return state

    def _clone(self, at: int, word: str, of: int, ends: list) -> int:
        copy = self._new(self.length[at] + 1, dict(self.next[of]), self.link[of], ends)
        self.link[of] = copy
        while at >= 0 and self.next[at].get(word) == of:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def stretches(self, words: list[str]) -> set[int]:
        """The window states met in a stream of words."""
        met, state, n, nexts, link, length, window, least = set(), 0, 0, self.next, self.link, self.length, self.window, self.stretch
        for word in words:
            after = nexts[state].get(word)
            while after is None and state > 0:
                state = link[state]
                n = length[state]
                after = nexts[state].get(word)
            if after is None:
                n = 0
                continue
            state, n = after, n + 1
            if n >= least:
                met.add(window[state])
        return met

    def spans(self, words: list[str], share: float = SHARE, long: int = LONG) -> list[bool]:
        """Which words to remove: those of stretches of ``long`` words, and of stretches of items that leak."""
        leaked = {n for n, (item, _) in enumerate(self.items)} & {n for n, _ in self._covered(words, share)}
        out, state, n = [False] * len(words), 0, 0
        for i, word in enumerate(words):
            while word not in self.next[state] and state > 0:
                state = self.link[state]
                n = self.length[state]
            if word not in self.next[state]:
                n = 0
                continue
            state, n = self.next[state][word], n + 1
            if n >= long:
                out[i - n + 1 : i + 1] = [True] * n
            elif n >= self.stretch and any(item in leaked for item, _ in self.ends[self.window[state]]):
                out[i - self.stretch + 1 : i + 1] = [True] * self.stretch
        return out

    def _covered(self, words: list[str], share: float) -> list[tuple[int, float]]:
        return [(n, len(c) / len(self.items[n][1])) for n, c in sorted(self.places(words).items()) if len(c) >= share * len(self.items[n][1])]

    def places(self, words: list[str]) -> dict[int, set[int]]:
        """By item the places of its words that stand in stretches of the text."""
        covered: dict[int, set[int]] = {}
        for state in self.stretches(words):
            for n, end in self.ends[state]:
                covered.setdefault(n, set()).update(range(end - self.stretch + 1, end + 1))
        return covered

    def leaks(self, words: list[str], share: float = SHARE) -> list[tuple[int, float]]:
        """``(item, covered share)`` of the items of which at least ``share`` is covered."""
        return [(self.items[n][0], c) for n, c in self._covered(words, share)]


_PIECE = re.compile(r"<[^<>]*>|&(?:#\d+|#[xX][0-9a-fA-F]+|\w+);?|[ÃÂØÙ][\u0080-ÿŒ-™]|â[\u0080-ÿŒ-™€]{2}|.", re.S)


def located(text: str) -> list[tuple[str, int, int]] | None:
    """The normalised words with where each begins and ends in the text; None if they can't be told apart there."""
    letters: list[str] = []
    begins: list[int] = []
    ends: list[int] = []
    for m in _PIECE.finditer(text):
        piece = m[0]
        if len(piece) > 1:
            piece = " " if piece[0] == "<" else html.unescape(piece) if piece[0] == "&" else _repaired(piece)
        for c in _HIDDEN.sub("", unicodedata.normalize("NFKD", piece)):
            if not unicodedata.combining(c):
                for folded in c.casefold():
                    letters.append(folded)
                    begins.append(m.start())
                    ends.append(m.end())
    found = [(m[0], begins[m.start()], ends[m.end() - 1]) for m in _WORD.finditer("".join(letters))]
    return found if [w for w, *_ in found] == normalised(text) else None


def without(text: str, automaton: ItemAutomaton, share: float = SHARE, long: int = LONG) -> tuple[str, int]:
    """The text without the spans to remove, and how many words went; the rest stays letter by letter.

    Where words can't be located in the text (mixed encodings), it becomes the kept words in their normalised form.
    """
    words = normalised(text)
    gone = automaton.spans(words, share, long)
    count = sum(gone)
    if not count:
        return text, 0
    places = located(text)
    if places is None:
        return " ".join(w for w, g in zip(words, gone) if not g), count
    out, at = [], 0
    for i, (_, begin, end) in enumerate(places):
        if gone[i]:
            if i == 0 or not gone[i - 1]:
                out.append(text[at:begin])
            at = end
    return "".join([*out, text[at:]]), count


def blocks(items: list[tuple[int, list[str]]], most: int = BLOCK_WORDS) -> Iterator[list[tuple[int, list[str]]]]:
    block: list[tuple[int, list[str]]] = []
    held = 0
    for item in items:
        if block and held + len(item[1]) > most:
            yield block
            block, held = [], 0
        block.append(item)
        held += len(item[1])
    if block:
        yield block


def leaked_items(texts: DataFrame, identifier: str, text: str, items: DataFrame, item: str, passage: str, share: float = SHARE) -> DataFrame:
    """``identifier, item, covered``: the items that leak into each text and the share of their words found there."""
    kind, item_kind = texts.schema[identifier].dataType.simpleString(), items.schema[item].dataType.simpleString()
    spark = texts.sparkSession
    schema = f"`{identifier}` string, `{item}` {item_kind}, covered double"
    named = texts.select(F.col(identifier).cast("string").alias(identifier), text)  # whole numbers beside nulls would come as floating point
    parts: list[DataFrame] = []
    # the items are the fixed test set; each block is one bounded broadcast
    listed = sorted(((r[0], normalised(r[1])) for r in items.select(item, passage).toLocalIterator() if r[0] is not None), key=lambda x: x[0])
    for block in blocks([x for x in listed if x[1]]):
        shared = spark.sparkContext.broadcast(ItemAutomaton(block))

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            automaton = shared.value
            for batch in batches:
                found = [(d, i, c) for d, t in zip(batch[identifier], batch[text]) if isinstance(t, str) for i, c in automaton.leaks(normalised(t), share)]
                yield pd.DataFrame(found, columns=[identifier, item, "covered"])

        parts.append(named.mapInPandas(scan, schema).withColumn(identifier, F.col(identifier).cast(kind)))
    if not parts:
        return spark.createDataFrame([], schema).withColumn(identifier, F.col(identifier).cast(kind))
    out = parts[0]
    for other in parts[1:]:
        out = out.unionByName(other)
    return out


def cleaned(texts: DataFrame, identifier: str, text: str, items: DataFrame, passage: str, share: float = SHARE, long: int = LONG) -> DataFrame:
    """``identifier, text, removed_words`` of every row: its text without the spans over the limits.

    A null text stays null with nothing removed.  Blocks of items follow one another in one pass over the texts.
    """
    spark, kind = texts.sparkSession, texts.schema[identifier].dataType.simpleString()
    schema = f"`{identifier}` string, `{text}` string, removed_words long"
    out = texts.select(F.col(identifier).cast("string").alias(identifier), text, F.lit(0).cast("long").alias("removed_words"))
    listed = [(n, w) for n, r in enumerate(items.select(passage).distinct().orderBy(passage).toLocalIterator()) if (w := normalised(r[0]))]  # the fixed test set
    for block in blocks(listed):
        shared = spark.sparkContext.broadcast(ItemAutomaton(block))

        def scan(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for batch in batches:
                done = [without(t, shared.value, share, long) if isinstance(t, str) else (None, 0) for t in batch[text]]
                yield pd.DataFrame({identifier: batch[identifier], text: [t for t, _ in done], "removed_words": batch["removed_words"] + [n for _, n in done]})

        out = out.mapInPandas(scan, schema)
    return out.withColumn(identifier, F.col(identifier).cast(kind))
