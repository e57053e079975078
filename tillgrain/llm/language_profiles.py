"""Language identification by rank-order profiles of letter n-grams.

A profile lists a language's most frequent 1-, 2- and 3-grams by falling frequency. A
document's own most frequent n-grams are compared with each profile: an n-gram costs
the difference of its two ranks, one that the profile lacks the profile's length. The
language of the least total wins.

n-grams are taken inside lower-cased words with a blank at both ends; any other
character than a letter is a blank. Profiles are learned from labelled rows: counts per
language over at most ``SAMPLE_ROWS`` rows of each language, those of the smallest hash
of doc_id. Their size depends on the number of languages alone, and they are broadcast
with the step.

Defined cases: a text that is null or has no letters gets ``und`` and score 0. Ties go to
the n-gram of the lower code points, and to the language first in the alphabet. Without
any labelled row every text gets ``und``. Repeated rows and rows without an id are
predicted like any other; columns besides the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.llm.support import importable, map_batches

PROFILE = 400
SAMPLE_ROWS = 2000
UNKNOWN = "und"
_BLANK = 32
_tables: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point, itself if it is a letter and else a blank."""
    if not _tables:
        points = range(0x110000)
        letter = np.fromiter((chr(p).isalpha() for p in points), dtype=bool, count=0x110000)
        _tables.append(np.where(letter, np.arange(0x110000), _BLANK).astype(np.int64))
    return _tables[0]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text as packed code points, and how often each occurs."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    c = np.full(points.size + 2, _BLANK, dtype=np.int64)
    c[1:-1] = _letters()[points]
    # Several blanks in a row count as one.
    keep = np.ones(c.size, dtype=bool)
    keep[1:] = (c[1:] != _BLANK) | (c[:-1] != _BLANK)
    c = c[keep]
    if c.size < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    inner = c != _BLANK
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    return np.unique(
        np.concatenate([c[inner], two, three[inner[1:-1]]]), return_counts=True
    )


def ranking(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, ties by code points."""
    if grams.size > 4 * size:
        least = np.partition(counts, grams.size - size)[grams.size - size]
        grams, counts = grams[counts >= least], counts[counts >= least]
    return grams[np.lexsort((grams, -counts))][:size]


def held_out() -> Column:
    """Whether a document is kept away from learning."""
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(key % 4 == 2, F.lit(False))


def learn(docs: DataFrame, size: int = PROFILE, rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """Profile of each value of ``lang``."""
    labelled = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # Ranked on the narrow columns; the limit per language applies before the shuffle too.
    chosen = (
        labelled.select("doc_id", "lang")
        .withColumn("_n", F.row_number().over(order))
        .where(F.col("_n") <= rows)
        .select("doc_id", "lang")
        .distinct()
    )
    sample = labelled.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        totals: dict[str, dict[int, int]] = {}
        for batch in batches:
            for lang, text in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                own = totals.setdefault(lang, {})
                grams, counts = ngrams(text)
                for gram, n in zip(grams.tolist(), counts.tolist(), strict=True):
                    own[gram] = own.get(gram, 0) + n
        for lang, own in totals.items():
            yield {
                "lang": pa.array([lang] * len(own), pa.string()),
                "gram": np.fromiter(own.keys(), np.int64, len(own)),
                "n": np.fromiter(own.values(), np.int64, len(own)),
            }

    counted = map_batches(sample.select("lang", "text"), step, "lang string, gram bigint, n bigint")
    top = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    ranked = (
        counted.groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(top))
        .where(F.col("place") <= size)
    )
    profiles: dict[str, list[int]] = {}
    for row in ranked.orderBy("lang", "place").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return {lang: np.array(grams, dtype=np.int64) for lang, grams in profiles.items()}


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], size: int = PROFILE) -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced).

    The score is 1 - distance / the largest possible distance: 1 for a document that
    ranks its n-grams as the profile does, 0 where it shares none with it.
    """
    docs = docs.drop("lang_pred", "score")
    names = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    languages = sorted(profiles)
    # All n-grams of any profile, and each language's rank of them (the size if absent).
    every = np.unique(np.concatenate([np.zeros(0, np.int64), *profiles.values()]))
    ranks = np.full((len(languages), every.size + 1), size, dtype=np.int64)
    for k, lang in enumerate(languages):
        ranks[k, np.searchsorted(every, profiles[lang])] = np.arange(profiles[lang].size)

    def distances(text: str) -> np.ndarray | None:
        grams, counts = ngrams(text)
        if grams.size == 0 or not languages:
            return None
        own = ranking(grams, counts, size)
        at = np.searchsorted(every, own)
        known = at < every.size
        known[known] = every[at[known]] == own[known]
        theirs = ranks[:, np.where(known, at, every.size)]
        cost = np.abs(theirs - np.arange(own.size))
        return np.where(theirs == size, size, cost).sum(axis=1) / (size * own.size)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, scores = [], []
            for text in batch.column(names.index("text")).to_pylist():
                found = distances(text) if text else None
                best = int(np.argmin(found)) if found is not None else 0
                named.append(languages[best] if found is not None else UNKNOWN)
                scores.append(float(1 - found[best]) if found is not None else 0.0)
            columns = [*batch.columns, pa.array(named, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    importable(docs.sparkSession)
    return docs.mapInArrow(step, fields + ", lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out, predict all of them."""
    profiles = learn(docs.where(~held_out()))
    found = predict(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
