"""Repetition inside a text, told by its suffix array.

The words of a text are numbered, and its suffixes sorted by doubling: round by round suffixes that
share 1, 2, 4, ... words are told apart by the rank of what follows. Neighbours in that order share the
longest prefixes there are; runs of neighbours with at least that many words in common (the intervals of the
longest-common-prefix array) are the repeated passages, and those that cannot be extended to either
side are the maximal ones. Their places, united, are the repeated part of the text.

Texts of a batch are sorted together in flat numpy arrays, in groups of about GROUP words; a longer text is a
group of its own, never cut. Only suffixes that still share a rank go on to the next round, so work follows
what is repeated, and memory is the text's words times the logarithm of its longest repeat at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP = 1 << 18
# White space between words, and the characters that count as symbols.
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"

FIELDS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "n_covered_words": "long", "longest_repeat": "long", "n_repeats": "long", "spans": "array<array<int>>",
}


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, text): the words of all texts as numbers, equal only for equal words of one text."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    words, _ = pd.factorize(np.array([w for t in texts for w in t], dtype=object))
    pairs = text * (int(words.max(initial=-1)) + 1) + words
    return pd.factorize(pairs)[0].astype(np.int64), text


def suffix_array(codes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The suffixes of all texts in order, and for 1, 2, 4, ... words which of them share a rank.

    A level holds (places ascending, ranks) of the suffixes that share that many words with another one.
    Codes differ between texts, so the suffixes of a text stand together.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    first = np.r_[True, codes[order][1:] != codes[order][:-1]] if n else np.zeros(0, dtype=bool)
    head = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = head
    # Places in the order that lie in a run of more than one.
    shared = np.flatnonzero(~(first & np.r_[first[1:], True])) if n else head
    levels = []
    step = 1
    while len(shared):
        active = order[shared]
        by_place = np.argsort(active)
        levels.append((active[by_place], rank[active][by_place]))
        after = active + step
        inside = after < n
        inside[inside] = text[after[inside]] == text[active[inside]]
        follows = np.where(inside, rank[np.minimum(after, n - 1)], -1)
        group = rank[active]
        moved = np.lexsort((follows, group))
        active, follows, group = active[moved], follows[moved], group[moved]
        order[shared] = active
        new = np.r_[True, (group[1:] != group[:-1]) | (follows[1:] != follows[:-1])]
        rank[active] = shared[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        shared = shared[~(new & np.r_[new[1:], True])]
        step *= 2
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Words that each suffix shares with the one before it in the order (0 for the first)."""
    n = len(order)
    shared = np.zeros(n, dtype=np.int64)
    if not levels:
        return shared
    pair = np.arange(1, n)
    left, right = order[:-1].copy(), order[1:].copy()
    rank = np.full(n + 1, -1, dtype=np.int64)
    # From the longest level down: what two suffixes share is a sum of distinct powers of two.
    for level in range(len(levels) - 1, -1, -1):
        places, ranks = levels[level]
        rank[places] = ranks
        a, b = rank[np.minimum(left, n)], rank[np.minimum(right, n)]
        same = (a >= 0) & (a == b)
        rank[places] = -1
        shared[pair[same]] += 1 << level
        left[same] += 1 << level
        right[same] += 1 << level
    return shared


def covered(order: np.ndarray, shared: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a passage of at least ``least`` words that its text repeats.

    Each suffix belongs to the deepest interval on either side of it. A passage that could be extended
    to the left lies inside the passage of the suffix before.
    """
    n = len(order)
    deepest = np.zeros(n, dtype=np.int64)
    deepest[order] = np.maximum(shared, np.r_[shared[1:], 0]) if n else shared
    ends = np.where(deepest >= least, np.arange(n) + deepest, 0)
    return np.maximum.accumulate(ends) > np.arange(n) if n else np.zeros(0, dtype=bool)


def maximal_repeats(
    order: np.ndarray, shared: np.ndarray, codes: np.ndarray, text: np.ndarray, least: int
) -> list[tuple[int, int, int]]:
    """(text, words, occurrences) of the maximal repeats of at least ``least`` words.

    Intervals come from one pass with a stack. One whose suffixes all follow the same word could be extended to
    the left and is no maximal repeat.
    """
    n = len(order)
    starts = np.r_[True, text[1:] != text[:-1]] if n else np.zeros(0, dtype=bool)
    before = np.where(starts, -1 - np.arange(n), np.r_[0, codes[:-1]] if n else codes)[order] if n else codes
    differs = np.cumsum(np.r_[0, before[1:] != before[:-1]]) if n else codes
    found = []
    stack: list[tuple[int, int]] = []  # (words, first place)
    places = np.flatnonzero(shared >= least)
    lengths = shared[places].tolist()
    places = places.tolist()
    for i, place in enumerate(places):
        first = place - 1
        if i and places[i - 1] != place - 1:
            _close(stack, places[i - 1], differs, found)
        while stack and stack[-1][0] > lengths[i]:
            words, first = stack.pop()
            _interval(words, first, place - 1, differs, found)
        if not stack or stack[-1][0] < lengths[i]:
            stack.append((lengths[i], first))
    if places:
        _close(stack, places[-1], differs, found)
    return [(int(text[order[first]]), words, last - first + 1) for words, first, last in found]


def _interval(words: int, first: int, last: int, differs: np.ndarray, found: list) -> None:
    if differs[last] > differs[first]:
        found.append((words, first, last))


def _close(stack: list[tuple[int, int]], last: int, differs: np.ndarray, found: list) -> None:
    while stack:
        words, first = stack.pop()
        _interval(words, first, last, differs, found)


def line_counts(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def measured(texts: list[bytes], least: int, window: int, with_spans: bool) -> Iterator[tuple]:
    """The FIELDS of each text."""
    group: list[tuple[bytes, list[bytes]]] = []
    size = 0
    for i, raw in enumerate(texts):
        words = raw.split()  # of bytes: white space is that of ASCII
        group.append((raw, words))
        size += len(words)
        if size >= GROUP or i + 1 == len(texts):
            yield from _measured_group(group, least, window, with_spans)
            group, size = [], 0


def _measured_group(group: list[tuple[bytes, list[bytes]]], least: int, window: int, with_spans: bool) -> Iterator[tuple]:
    n = len(group)
    codes, text = numbered([words for _, words in group])
    order, levels = suffix_array(codes, text)
    shared = common_prefixes(order, levels)
    in_window = np.bincount(text, weights=covered(order, shared, window), minlength=n)
    in_repeat = covered(order, shared, least)
    in_passage = np.bincount(text, weights=in_repeat, minlength=n)
    longest = np.zeros(n, dtype=np.int64)
    np.maximum.at(longest, text[order], shared)
    repeats = np.bincount([t for t, _, _ in maximal_repeats(order, shared, codes, text, least)], minlength=n)
    starts = np.searchsorted(text, np.arange(n))
    for i, (raw, words) in enumerate(group):
        spans = None
        if with_spans:
            own = np.r_[0, in_repeat[starts[i]:starts[i] + len(words)].astype(np.int8), 0]
            spans = np.flatnonzero(np.diff(own)).reshape(-1, 2).tolist()
        yield (
            len(words), len(raw.decode()) - sum(raw.count(bytes((s,))) for s in SPACES),
            sum(raw.count(bytes((s,))) for s in SYMBOLS), line_counts(raw), int(in_window[i]), int(in_passage[i]),
            int(longest[i]), int(repeats[i]), spans,
        )


def rated(
    df: DataFrame,
    text: str = "text",
    least: int = 10,
    window: int = 3,
    most_covered: int = 30,
    most_words: int = 50,
    least_words: int = 50,
    most_repeated: int = 50,
    with_spans: bool = True,
) -> DataFrame:
    """Adds the repetition of each text and whether it is kept; rows stay as they are otherwise.

    Words are runs of anything but ASCII white space. Adds n_words, word_chars (code points in words), n_symbols,
    n_dup_lines (lines with a word that equal an earlier one), n_repeat_words (words in passages of ``window``
    or more words that occur twice), n_covered_words (the same for ``least`` or more words, the union of all maximal
    repeats), longest_repeat (words), n_repeats (maximal repeats of ``least`` words or more), spans (word ranges of
    the covered part, first to last exclusive; null unless wanted), base_failed and kept.

    ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeated`` percent of them are repeat
    words. Otherwise a text is kept unless more than ``most_covered`` percent of its words are covered or its longest
    repeat has more than ``most_words`` words. Null and empty texts have no words and fail. Occurrences may
    overlap each other. Every text is judged whole and alone, so repeated rows and ties do not matter. Columns of
    these names are replaced, all others stay.
    """
    schema = ", ".join(f"{k} {v}" for k, v in FIELDS.items())

    @F.pandas_udf(schema)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            raw = [t.encode() if t else b"" for t in texts]
            yield pd.DataFrame(list(measured(raw, least, window, with_spans)), columns=list(FIELDS))

    taken = df.withColumn("_llm_repetition", measure(F.col(text)))
    for name in FIELDS:
        taken = taken.withColumn(name, F.col("_llm_repetition")[name])
    words = F.col("n_words")
    failed = (words < least_words) | (100 * F.col("n_repeat_words") > most_repeated * words)
    good = (100 * F.col("n_covered_words") <= most_covered * words) & (F.col("longest_repeat") <= most_words)
    return taken.drop("_llm_repetition").withColumn("base_failed", failed).withColumn("kept", ~failed & good)
