"""Substring dedup: sentences inside a run of sentences that stood earlier are removed.

Sentences end at ``.``, ``!``, ``?`` or a line end. Long ones are cut further: of
``WINDOW`` words in a row without an end, the one of the smallest hash ends a piece. Each
end depends on the words around it alone, never on where the text starts. A run starts at
every sentence and has at least ``RUN_SENTENCES`` sentences and ``RUN_WORDS`` words
(``TAIL_WORDS`` where the text ends); its hash has 96 bits and covers the words with A-Z as
a-z.

In a passage that stands in two texts, the ends from the word WINDOW on to the word WINDOW
before its last are the same in both and at most WINDOW words apart. So every passage of
4 * WINDOW + RUN_WORDS - 1 words or more (51) holds a run, whatever its lines, stops and
neighbours; up to two windows of words at its start and three at its end can stay.

The first place of a run is the one in the smallest doc_id, and there the leftmost. At
every other place all its sentences go, with the white space after them. The runs are
grouped by hash (partial aggregates, so a run in a third of all documents costs one row
per task), then joined with those that occur in two documents or more; repeats inside a
document are found where its text is read. Nothing is capped.

Defined cases: a null text stays null, a text with fewer sentences than a run stays as it
is. A row without an id neither gives nor loses sentences across documents. Rows that
repeat an id are one document: texts under one id take nothing from each other. Columns besides doc_id and text are passed through;
``n_sentences`` and ``n_removed`` of the input are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.support import importable, map_batches, texts_of
from tillgrain.llm.words import mix, run_hashes, word_hashes

RUN_SENTENCES = 3
RUN_WORDS = 20
TAIL_WORDS = 16
WINDOW = 8
_SECOND_BASE = 0xD6E8FEB86659FD93
_ENDINGS = np.isin(np.arange(256), list(b".!?"))


def _window_ends(ends: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The word of the smallest hash, the last of equal ones, of each window without an end."""
    if words.size < WINDOW:
        return np.zeros(0, dtype=np.int64)
    before = np.concatenate([[0], np.cumsum(ends)])
    open_windows = np.flatnonzero(before[WINDOW:] == before[:-WINDOW])
    hashes = sliding_window_view(mix(words, 3), WINDOW)[open_windows, ::-1]
    return open_windows + (WINDOW - 1 - hashes.argmin(axis=1))


class Sentences:
    """Bounds of a text's sentences and the hashes of its runs."""

    def __init__(self, text: bytes) -> None:
        data = np.frombuffer(text, dtype=np.uint8)
        starts, ends, self.words = word_hashes(text, lower=True)
        last = starts.size - 1
        if last < 0:
            self.byte_starts = self.first = self.last = np.zeros(0, dtype=np.int64)
            return
        line = np.concatenate([[0], np.cumsum(data == 0x0A)])
        final = _ENDINGS[data[ends - 1]]
        final[:-1] |= line[starts[1:]] != line[ends[:-1]]
        final[_window_ends(final, self.words)] = True
        final[last] = True
        self.last = np.flatnonzero(final)
        self.first = np.concatenate([[0], self.last[:-1] + 1])
        self.byte_starts = starts[self.first]

    def __len__(self) -> int:
        return self.first.size

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First and last sentence, and two hashes, of the run starting at each sentence."""
        begin = np.arange(len(self))
        end = np.searchsorted(self.last, self.first + RUN_WORDS - 1)
        end = np.minimum(np.maximum(end, begin + RUN_SENTENCES - 1), len(self) - 1)
        long = (end - begin >= RUN_SENTENCES - 1) & (
            self.last[end] - self.first + 1 >= TAIL_WORDS
        )
        # Only starts close to the end of the text fall short.
        begin, end = begin[long], end[long]
        if begin.size == 0:
            none = np.zeros(0, dtype=np.int64)
            return begin, end, none, none.astype(np.int32)
        words = self.first[begin], self.last[end] + 1
        one = run_hashes(self.words, *words).view(np.int64)
        two = (run_hashes(self.words, *words, _SECOND_BASE) >> np.uint64(32)).astype(np.uint32)
        return begin, end, one, two.view(np.int32)


def _first_in_text(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Whether each run is the leftmost of its hash in the text."""
    if np.unique(one).size == one.size:
        return np.ones(one.size, dtype=bool)
    order = np.lexsort((np.arange(one.size), two, one))
    first = np.ones(one.size, dtype=bool)
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    first[order[1:][same]] = False
    return first


def runs(docs: DataFrame) -> DataFrame:
    """(h1, h2, doc_id, tag): every distinct run of every text."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            tags = batch.column(1).to_numpy(zero_copy_only=False)
            parts, lengths = [], []
            for text in texts_of(batch):
                _, _, one, two = Sentences(text).runs()
                first = _first_in_text(one, two)
                parts.append((one[first], two[first]))
                lengths.append(int(first.sum()))
            yield {
                "h1": np.concatenate([p[0] for p in parts]),
                "h2": np.concatenate([p[1] for p in parts]),
                "doc_id": np.repeat(ids, lengths),
                "tag": np.repeat(tags, lengths),
            }

    return map_batches(
        _tagged(docs.where("doc_id is not null and text is not null")),
        step,
        "h1 bigint, h2 int, doc_id bigint, tag smallint",
    )


def _tagged(docs: DataFrame) -> DataFrame:
    """The tag spreads different texts that share an id. Two of them may have the same one:
    marks are hashes of runs, so those of one text change nothing in another that lacks
    the run."""
    return docs.select("doc_id", _tag(), "text")


def _tag():
    return F.pmod(F.xxhash64("text"), F.lit(32749)).cast("smallint").alias("tag")


def repeated_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, hashes): runs of each text that stand in a smaller doc_id too."""
    every = runs(docs)
    shared = (
        every.groupBy("h1", "h2")
        .agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("texts"))
        .where("texts > 1")
        .select("h1", "h2", "first_id")
    )
    return (
        every.join(shared, ["h1", "h2"])
        .where("doc_id > first_id")
        .groupBy("doc_id", "tag")
        .agg(F.collect_set("h1").alias("hashes"))
    )


def _cleaned(text: bytes, repeated: np.ndarray) -> tuple[bytes, int, int]:
    """The text without its repeated runs, its sentences, how many of them went."""
    found = Sentences(text)
    begin, end, one, two = found.runs()
    again = ~_first_in_text(one, two)
    again |= np.isin(one, repeated)
    if not again.any():
        return text, len(found), 0
    change = np.zeros(len(found) + 1, dtype=np.int64)
    np.add.at(change, begin[again], 1)
    np.add.at(change, end[again] + 1, -1)
    gone = np.cumsum(change[:-1]) > 0
    bounds = np.append(found.byte_starts, len(text))
    kept = [text[: bounds[0]]]
    kept += [text[bounds[i] : bounds[i + 1]] for i in np.flatnonzero(~gone)]
    return b"".join(kept), len(found), int(gone.sum())


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated runs of sentences cut out of ``text``, and two counts."""
    importable(docs.sparkSession)
    docs = docs.drop("n_sentences", "n_removed")
    marks = repeated_runs(docs).select(
        F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"), F.col("hashes").alias("_hashes")
    )
    marked = docs.join(
        marks, (docs["doc_id"] == F.col("_id")) & (_tag() == F.col("_tag")), "left"
    ).select(*docs.columns, "_hashes")
    names = docs.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        for batch in batches:
            texts, totals, removed = [], [], []
            missing = batch.column(at).is_null().to_pylist()
            for text, hashes, null in zip(
                texts_of(batch), batch.column(len(names)), missing, strict=True
            ):
                repeated = np.array(hashes.as_py() or [], dtype=np.int64)
                clean, total, gone = _cleaned(text, repeated)
                texts.append(None if null else clean.decode())
                totals.append(total)
                removed.append(gone)
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(texts, pa.string())
            columns += [pa.array(totals, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_sentences", "n_removed"])

    return marked.mapInArrow(step, fields + ", n_sentences bigint, n_removed bigint")
