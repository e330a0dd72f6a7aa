"""Byte-level BPE by batched numpy merge rounds, and the way back.

A text is cut into words by the public pattern of this kind of vocabulary. The symbols of all words
of a batch that were not met before lie in one flat array. A round looks up the rank of every pair
of neighbours by binary search over the sorted pair keys, finds each word's lowest rank, and merges
all places of that pair in that word, left to right. A word without a known pair is done. A merged
symbol only takes part in later merges, so a round per rank gives what one merge at a time gives.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import built_once

# The white space of the pattern, and the pattern that parts words.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+|"
    rf" ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)
# Words kept with their ids by a worker; beyond it the memory starts afresh.
REMEMBERED = 500_000
# Characters of the texts whose new words are merged together; one longer text is a group of its own.
GROUP = 1 << 20
NONE = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a vocabulary file: printable ones as they are."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """The tokens and merges of a file of the tokenizers library with a byte-level BPE model."""

    def __init__(self, source: str):
        file = json.loads(source)
        letters, vocab = byte_letters(), file["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes = {i: bytes(letters[c] for c in t) for t, i in vocab.items() if t not in self.special}
        self.bytes |= {i: t.encode() for t, i in self.special.items()}
        self.of_byte = np.zeros(256, dtype=np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in file["model"]["merges"]]
        self.size = 1 + max(self.bytes)
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        names = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.parts = regex.compile(f"({names})") if names else None
        self.words = regex.compile(PATTERN)
        self.memory: dict[str, bytes] = {}

    def ranked(self, symbols: np.ndarray, word: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at these places; NONE where the word ends or the pair is unknown."""
        here = np.minimum(at, len(symbols) - 2)
        pair = symbols[here] * self.size + symbols[here + 1]
        found = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        known = (self.keys[found] == pair) & (word[here] == word[here + 1]) & (here == at)
        return np.where(known, self.ranks[found], NONE)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols after all merges, with the number of the word each belongs to (ascending).

        Words that are done leave the array, and only pairs that a merge touched are looked up anew.
        """
        done_symbols, done_words = [], []
        if len(symbols) < 2 or not len(self.keys):
            return symbols, word
        rank = self.ranked(symbols, word, np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lengths = np.diff(np.r_[first, len(symbols)])
            lowest = np.repeat(np.minimum.reduceat(rank, first), lengths)
            over = lowest == NONE
            if over.any():
                done_symbols.append(symbols[over])
                done_words.append(word[over])
                symbols, word, rank, lowest = symbols[~over], word[~over], rank[~over], lowest[~over]
                if not len(symbols):
                    break
            # In a run of touching places (one symbol repeated) every second one merges, from the left.
            places = np.flatnonzero(rank == lowest)
            fresh = np.r_[True, np.diff(places) != 1]
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
            places = places[(np.arange(len(places)) - start) % 2 == 0]
            symbols[places] = self.made[rank[places]]
            left = np.ones(len(symbols), dtype=bool)
            left[places + 1] = False
            symbols, word, rank = symbols[left], word[left], rank[left]
            merged = places - np.arange(len(places))
            if len(symbols) > 1:
                touched = np.concatenate([merged, merged[merged > 0] - 1])
                rank[touched] = self.ranked(symbols, word, touched)
            else:
                rank[:] = NONE
        words = np.concatenate(done_words)
        order = np.argsort(words, kind="stable")
        return np.concatenate(done_symbols)[order], words[order]

    def learn(self, words: list[str]) -> None:
        """Puts the packed ids of new words into the memory, all of them merged in one flat array."""
        raw = [w.encode() for w in words]
        number = np.repeat(np.arange(len(raw)), list(map(len, raw)))
        ids, owner = self.merge(self.of_byte[np.frombuffer(b"".join(raw), dtype=np.uint8)], number)
        ends = (4 * np.searchsorted(owner, np.arange(1, len(raw) + 1))).tolist()
        packed = ids.astype("<u4").tobytes()
        self.memory.update(zip(words, (packed[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))

    def split(self, text: str) -> list[str]:
        """Words and special tokens in the order of the text."""
        if self.parts is None or not self.parts.search(text):
            return self.words.findall(text)
        out: list[str] = []
        for piece in self.parts.split(text):
            out += [piece] if piece in self.special else self.words.findall(piece)
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, in order, as little-endian unsigned 32-bit integers.

        Texts are taken in groups of about GROUP characters, and a group's new words are merged together.
        """
        group: list[list[str]] = []
        size = 0
        for i, text in enumerate(texts):
            group.append(self.split(text))
            size += len(text)
            if size >= GROUP or i + 1 == len(texts):
                if len(self.memory) > REMEMBERED:
                    self.memory.clear()
                self.memory.update((t, n.to_bytes(4, "little")) for t, n in self.special.items())
                new = set().union(*group).difference(self.memory)
                if new:
                    self.learn(list(new))
                for words in group:
                    yield b"".join(map(self.memory.__getitem__, words))
                group, size = [], 0

    def decode(self, packed: bytes) -> str:
        """Bytes that are no UTF-8 become the replacement character."""
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", errors="replace")


def tokenised(df: DataFrame, vocabulary: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """Adds n_tokens, ids_sha256, decoded_sha256 and, if wanted, ids array<int> and decoded string.

    ``vocabulary`` is the path of the vocabulary file on the driver; its bounded content is sent to
    the tasks. Ids equal those of the tokenizers library without added special tokens; special
    tokens that stand in a text are taken as such. A null text counts as empty: no ids. Columns of
    these names are replaced.
    """
    with open(vocabulary, encoding="utf-8") as file:
        source = file.read()
    shared, key = df.sparkSession.sparkContext.broadcast(source), uuid.uuid4().hex
    fields = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>", "decoded string"] * with_ids
    names = [f.split(" ")[0] for f in fields]

    @F.pandas_udf(", ".join(fields))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocab = built_once(key, lambda: Vocabulary(shared.value))
        for texts in batches:
            rows = []
            for packed in vocab.encode([t or "" for t in texts]):
                back = vocab.decode(packed)
                row = [len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest()]
                rows.append(row + [np.frombuffer(packed, dtype="<i4"), back] * with_ids)
            yield pd.DataFrame(rows, columns=names)

    out = df.withColumn("_llm_tokens", encode(F.col(text)))
    for name in names:
        out = out.withColumn(name, F.col("_llm_tokens")[name])
    return out.drop("_llm_tokens")
