"""Benchmark passages in documents, by one Aho-Corasick automaton over the items' word windows.

Items and texts are normalised alike (A-Z in lower case; words are runs of ASCII letters, digits and
characters beyond ASCII). A window is 10 consecutive words of an item, or all of a shorter item. The
automaton runs over word numbers, so a text is scanned once, word by word, and what it finds are
places of words; their offsets in the original text come from the same byte-for-byte normalisation.

The items are a stated set, gathered in blocks of at most ``block_words`` words; a larger set takes
one pass of the texts for each block, so a task never holds more than one block's automaton.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import WORD_BYTES, built_once, keep, word_list

WINDOW = 10
BLOCK_WORDS = 500_000
FOUND = "words long, starts array<int>, ends array<int>, items array<string>, begin array<int>, stop array<int>"
_WORD = re.compile(rb"[^ ]+")


class Index:
    """The automaton of one block of items, and the numbers of their words."""

    def __init__(self, items: Iterable[tuple[str | None, str]], window: int):
        self.numbers: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in word_list(text))
            for start in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(words[start : start + window], set()).update([] if item is None else [item])
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for key, ids in owners.items():
            self.automaton.add_word(key, (len(key), ids))
        if owners:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[int], list[int], list[str]]:
        """Words of the text; merged spans of hit words, as starts and ends; the items found."""
        words = word_list(text)
        starts: list[int] = []
        ends: list[int] = []
        items: set[str] = set()
        if words and len(self.automaton):
            number = self.numbers.get
            for last, (length, ids) in self.automaton.iter(tuple([number(w, 0) for w in words])):
                items |= ids
                # Ends never fall back; a shorter window may begin after a longer one that ends with it.
                begin = last + 1 - length
                while starts and begin <= starts[-1]:
                    starts.pop(), ends.pop()
                if starts and begin <= ends[-1]:
                    ends[-1] = last + 1
                else:
                    starts.append(begin)
                    ends.append(last + 1)
        return len(words), starts, ends, sorted(items)


def offsets(text: str, starts: list[int], ends: list[int]) -> tuple[list[int], list[int]]:
    """The spans of words as places of characters in the original text."""
    raw = text.encode()
    first, last = set(starts), {e - 1 for e in ends}
    begin, stop, at, byte = [], [], 0, 0
    for i, word in enumerate(_WORD.finditer(raw.translate(WORD_BYTES))):
        if i in first:
            at, byte = at + len(raw[byte : word.start()].decode()), word.start()
            begin.append(at)
        if i in last:
            at, byte = at + len(raw[byte : word.end()].decode()), word.end()
            stop.append(at)
    return begin, stop


def scanner(df: DataFrame, items: list[tuple[str | None, str]], window: int):
    """A column function that scans a text with the automaton of these items."""
    shared, key = df.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

    @F.pandas_udf(FOUND)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        index = built_once(key, lambda: Index(shared.value, window))
        for texts in batches:
            rows = []
            for text in texts:
                words, starts, ends, found = index.scan(text)
                begin, stop = offsets(text, starts, ends) if starts else ([], [])
                rows.append((words, starts, ends, found, begin, stop))
            yield pd.DataFrame(rows, columns=["words", "starts", "ends", "items", "begin", "stop"])

    return scan


def blocks(items: DataFrame, item: str, text: str, block_words: int) -> Iterator[list[tuple[str | None, str]]]:
    """The items in blocks of at most ``block_words`` words (one item at least)."""
    block: list[tuple[str | None, str]] = []
    size = 0
    rows = items.where(F.col(text).isNotNull()).select(F.col(item).cast("string"), text)
    for key, value in rows.toLocalIterator():
        words = len(word_list(value))
        if block and size + words > block_words:
            yield block
            block, size = [], 0
        block.append((key, value))
        size += words
    yield block


def merged(one: Column, other: Column) -> Column:
    """Places found by two scans: spans as they are (they may overlap), items distinct."""
    return F.struct(
        one["words"].alias("words"),
        F.concat(one["starts"], other["starts"]).alias("starts"),
        F.concat(one["ends"], other["ends"]).alias("ends"),
        F.array_sort(F.array_union(one["items"], other["items"])).alias("items"),
        F.concat(one["begin"], other["begin"]).alias("begin"),
        F.concat(one["stop"], other["stop"]).alias("stop"),
    )


def scanned(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    into: str = "found",
) -> DataFrame:
    """Adds a column, ``found`` if not named otherwise: words, word spans (starts, ends), items, character spans (begin, stop).

    A null or empty text has no words and no hits. Items without words, or null, have no windows; an
    item with a null id marks words but is not listed. Repeated items and repeated rows change
    nothing. An empty table of items finds nothing. A column of that name is replaced.
    """
    out = None
    for block in blocks(items, item, item_text, block_words):
        if out is None:
            out = df.withColumn(into, scanner(df, block, window)(F.col(text)))
        else:
            out = keep(out.withColumn("_llm_more", scanner(df, block, window)(F.col(text))), "scanned")
            out = out.withColumn(into, merged(F.col(into), F.col("_llm_more"))).drop("_llm_more")
    return out


def covered(found: Column) -> Column:
    """Words in any of the spans; those of several scans may overlap."""
    spans = F.array_sort(F.arrays_zip(found["starts"].alias("start"), found["ends"].alias("end")))
    none = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("reach"))

    def add(sum_, span):
        more = F.greatest(F.lit(0), span["end"] - F.greatest(span["start"], sum_["reach"]))
        return F.struct((sum_["total"] + more).alias("total"), F.greatest(sum_["reach"], span["end"]).alias("reach"))

    return F.aggregate(spans, none, add)["total"]


def contaminated(df: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Adds n_words, n_hit, hit_items array<string>, hit_spans array<struct<begin, stop>>, contaminated."""
    out = scanned(df, items, text, **options, into="_llm_found")
    found = F.col("_llm_found")
    out = out.withColumn("n_words", found["words"]).withColumn("n_hit", covered(found))
    out = out.withColumn("hit_items", found["items"])
    out = out.withColumn("hit_spans", F.arrays_zip(found["begin"].alias("begin"), found["stop"].alias("stop")))
    return out.withColumn("contaminated", F.col("n_hit") > 0).drop("_llm_found")


def clean(df: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows without a hit, with the columns they came with."""
    out = scanned(df, items, text, into="_llm_found")
    return out.where(F.size(F.col("_llm_found")["starts"]) == 0).drop("_llm_found")


def items_digest(items: Column) -> Column:
    """Lower-case hex SHA-256 of the ids, sorted as strings and joined with commas."""
    return F.sha2(F.array_join(F.array_sort(items), ","), 256)
