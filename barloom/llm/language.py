"""Language of a text by its nearest centroid.

A text becomes counts of its letter 1- to 3-grams (of the UTF-8 bytes in lower case, hashed into
``DIMENSIONS`` cells), weighted by log(1 + count) and inverse document frequency and normalised.
Every language has up to ``CENTROIDS`` centroids, found by spherical k-means over labelled texts, since
one language holds several kinds of text; a few odd texts get none of their own. The nearest centroid
by cosine names the language. A text is rejected if it is farther from it than nearly all labelled
texts of that language and of like length are from centroids that were found without them.

Document frequencies are counted over all labelled rows. The centroids are fitted on a bounded sample:
of each language, the labelled text with the least hash in each of ``SAMPLE`` buckets. The bound is
that parameter; scoring covers all texts, in whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 4096
CENTROIDS = 4
SAMPLE = 500
# A text seeds a cluster from so many n-grams; a cluster holds one in ``FEW`` of its language's texts at least.
SEED_GRAMS = 200
FEW = 50
# A text is rejected below this part of the LOW quantile of the cosines of labelled texts of its language
# and of like length; with fewer than MANY such texts, whose least says little of others, below FEWER of it.
REJECT, FEWER = 0.8, 0.5
LOW = 0.01
MANY = 100
# Lengths count by powers of two of n-grams, the last one and beyond as one. Labelled texts give
# short pieces too, from their first HEAD characters.
BANDS = 13
HEAD = 1024
UNKNOWN = "und"
BLOCK = 256
# ASCII other than letters parts words; bytes beyond ASCII belong to letters, mostly.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def counts(text: str | None) -> np.ndarray:
    """Hashed counts of the 1- to 3-grams of the whole text, spaces only as edges of words."""
    raw = b" ".join((text or "").lower().encode().translate(_LETTERS).split())
    if not raw:
        return np.zeros(DIMENSIONS, dtype=np.float32)
    one = np.frombuffer(b" " + raw + b" ", dtype=np.uint8).astype(np.uint32)
    two = one[:-1] << np.uint32(8) | one[1:]
    three = two[:-1] << np.uint32(8) | one[2:]
    # A byte leads each gram's number, so grams of different lengths differ before hashing.
    grams = np.concatenate([one[1:-1] | np.uint32(1 << 24), two | np.uint32(2 << 24), three | np.uint32(3 << 24)])
    cells = (grams * np.uint32(2654435769)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)
    return np.bincount(cells, minlength=DIMENSIONS).astype(np.float32)


@dataclass(frozen=True)
class Model:
    """Unit centroids by row, the language of each, the least cosine it accepts in the middle of each band, and the weights."""

    languages: list[str]
    centroids: np.ndarray
    floors: np.ndarray
    weights: np.ndarray

    def unit(self, raw: np.ndarray) -> np.ndarray:
        out = np.log1p(raw) * self.weights
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, cosine and rejection of each text."""
        out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, True)] * len(texts)
        known = [i for i, t in enumerate(texts) if t and self.languages and has_letter(t)]
        for start in range(0, len(known), BLOCK):
            part = known[start : start + BLOCK]
            raw = np.stack([counts(texts[i]) for i in part])
            near, place = self.unit(raw) @ self.centroids.T, np.log2(np.maximum(1, raw.sum(axis=1))) - 0.5
            for i, best, row, at in zip(part, near.argmax(axis=1), near, place, strict=True):
                score = min(1.0, max(0.0, round(float(row[best]), 6)))
                out[i] = (self.languages[best], score, bool(score < np.interp(at, range(BANDS), self.floors[best])))
        return out


def drawn(points: np.ndarray, free: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Seeds among the ``free`` points, each drawn in proportion to its squared distance from those before."""
    own = points[free]
    centers = [own[rng.integers(len(own))]]
    while len(centers) < min(k, len(own)):
        # Of unit vectors, half the squared distance.
        far = np.maximum(0, 1 - (own @ np.stack(centers).T).max(axis=1)).astype(np.float64)
        if far.sum() < 1e-6:
            break
        centers.append(own[rng.choice(len(own), p=far / far.sum())])
    return np.stack(centers)


def settled(points: np.ndarray, out: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Rounds of spherical k-means from the given centres."""
    for _ in range(rounds):
        nearest = (points @ out.T).argmax(axis=1)
        sums = np.stack([points[nearest == c].sum(axis=0) if (nearest == c).any() else out[c] for c in range(len(out))])
        out = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return out


def clusters(points: np.ndarray, grams: np.ndarray, k: int, tries: int = 8) -> np.ndarray:
    """Spherical k-means, with no centre for a few odd texts.

    Texts of fewer than ``SEED_GRAMS`` n-grams seed nothing, unless there are no others. Texts that
    end up in clusters of a few seed nothing the next time, and clusters that stay so small in the
    last try join the others. All texts count in the centres.
    """
    rng = np.random.default_rng(0)
    free = grams >= SEED_GRAMS if (grams >= SEED_GRAMS).any() else np.ones(len(points), dtype=bool)
    least = min(len(points), max(2, len(points) // FEW))
    for _ in range(tries):
        out = settled(points, drawn(points, free, k, rng))
        nearest = (points @ out.T).argmax(axis=1)
        held = np.bincount(nearest, minlength=len(out))
        if held.min() >= least:
            return out
        rest = free & (held[nearest] >= least)
        free = rest if rest.any() else free
    return settled(points, out[held >= min(least, held.max())])


def document_frequencies(labelled: DataFrame) -> tuple[int, np.ndarray]:
    """The number of rows of (text) and, for each cell, of those that have it; ``DIMENSIONS`` numbers at most."""

    def held(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The cell beyond the last counts the rows.
        rows = np.zeros(DIMENSIONS + 1, dtype=np.int64)
        for batch in batches:
            for text in batch["text"]:
                rows[:-1] += counts(text) > 0
                rows[-1] += 1
        found = np.flatnonzero(rows)
        yield pd.DataFrame({"cell": found, "n": rows[found]})

    out = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for r in labelled.select("text").mapInPandas(held, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return int(out[-1]), out[:-1]


def least_cosines(raw: np.ndarray, heads: list[str], unit: Callable[[np.ndarray], np.ndarray]) -> list[float]:
    """The least cosine to accept in each band, by texts of one language and pieces of them.

    Centroids of one half of the texts measure the other half.
    """
    found: list[list[float]] = [[] for _ in range(BANDS)]
    half = np.arange(len(raw)) % 2
    for side in (0, 1):
        rest, own = raw[half != side], np.flatnonzero(half == side)
        if not len(rest) or not len(own):
            continue
        centroids = clusters(unit(rest), rest.sum(axis=1), CENTROIDS)
        sets = [raw[own]]
        for band in range(BANDS - 1):
            # A character has about three n-grams; pieces fall into the band their own n-grams say.
            size = round(2 ** (band + 0.5) / 3)
            pieces = [counts(heads[i][:size]) for i in own if len(heads[i]) >= size]
            sets += [np.stack(pieces)] if size and pieces else []
        for texts in sets:
            texts = texts[texts.any(axis=1)]
            bands = np.minimum(np.log2(np.maximum(1, texts.sum(axis=1))).astype(int), BANDS - 1)
            for band, cosine in zip(bands, (unit(texts) @ centroids.T).max(axis=1, initial=0), strict=True):
                found[band].append(float(cosine))
    out: list[float] = []
    for cosines in found:
        part = REJECT if len(cosines) >= MANY else FEWER
        # A band without texts accepts what the next shorter one does.
        out.append(part * float(np.quantile(cosines, LOW)) if cosines else out[-1] if out else 0.0)
    return out


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model of the labelled rows; at most ``sample`` texts of a language reach the driver.

    Rows without a text or a language are left out. No labelled rows give a model that knows no
    language. Equal texts count once in the centroids, so groups of copies don't outweigh the rest; the
    document frequencies are of all rows.
    """
    hashed = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    hashed = hashed.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(text).alias("hash"))
    least = hashed.groupBy("lang", F.pmod("hash", F.lit(sample)).alias("bucket")).agg(F.min("hash").alias("hash"))
    # At most ``sample`` numbers of each language, as the sample itself: small enough to send to all tasks.
    chosen = hashed.join(F.broadcast(least.select("lang", "hash")), ["lang", "hash"], "left_semi")

    @F.pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        return pd.Series([counts(t).astype(np.uint32).tobytes() for t in texts])

    rows = chosen.select("lang", "hash", packed("text").alias("grams"), F.substring("text", 1, HEAD).alias("head"))
    rows = rows.groupBy("lang", "hash").agg(F.min(F.struct("grams", "head")).alias("least")).select("lang", "hash", "least.*")
    rows = sorted(rows.collect(), key=lambda r: (r["lang"], r["hash"]))
    if not rows:
        return Model([], np.zeros((0, DIMENSIONS)), np.zeros((0, BANDS)), np.ones(DIMENSIONS))
    raw = np.stack([np.frombuffer(r["grams"], dtype=np.uint32) for r in rows]).astype(np.float32)
    total, frequencies = document_frequencies(hashed)
    weights = (np.log((1 + total) / (1 + frequencies)) + 1).astype(np.float32)
    unit = Model([], raw, raw, weights).unit
    points = unit(raw)
    of = np.array([r["lang"] for r in rows])
    languages, centroids, floors = [], [], []
    for name in sorted(set(of)):
        own = points[of == name]
        found = clusters(own, raw[of == name].sum(axis=1), CENTROIDS)
        floor = least_cosines(raw[of == name], [r["head"] for r in rows if r["lang"] == name], unit)
        languages += [name] * len(found)
        centroids.append(found)
        floors += [floor] * len(found)
    return Model(languages, np.concatenate(centroids).astype(np.float32), np.array(floors), weights)


def prediction(df: DataFrame, model: Model, text: str = "text") -> Column:
    """struct<lang_pred, score, rejected> of a text of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(shared.value.predict(list(texts)), columns=["lang_pred", "score", "rejected"])

    return predict(F.col(text))


def predicted(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Adds lang_pred, score (cosine, 0 to 1) and rejected.

    A null text, or one without a letter, is ``und`` with score 0 and rejected, as is every text if
    the model knows no language. A text that is only too far from its nearest centroid keeps that
    centroid's language and is rejected. Columns of these names are replaced.
    """
    out = df.withColumn("_llm_language", prediction(df, model, text))
    for name in ("lang_pred", "score", "rejected"):
        out = out.withColumn(name, F.col("_llm_language")[name])
    return out.drop("_llm_language")


def held_out(key: Column) -> Column:
    """Every fourth document by the CRC-32 of its id as text; never learnt from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_documents(docs: DataFrame) -> Model:
    """The model of the rows of ``documents`` that are not held out; a row without an id is not held out."""
    return fit(docs.where(~held_out(F.col("doc_id"))))


def accepted(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose language is not rejected, with the columns they came with."""
    told = df.withColumn("_llm_language", prediction(df, model, text))
    return told.where(~F.col("_llm_language")["rejected"]).drop("_llm_language")
