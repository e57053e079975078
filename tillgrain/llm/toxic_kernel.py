"""Toxicity by a support vector machine over a subsequence string kernel.

The kernel of two strings counts the four-letter subsequences they share, gaps allowed
within seven signs, each weighted by ``DECAY`` per sign it is stretched:

    K(s, t) = sum over u of phi_u(s) phi_u(t),  phi_u(s) = sum over places of DECAY ** (span - 4)

divided by the self-similarity that strings of their lengths have. So ``idxiot``, ``id-iot``
and ``i d i o t`` stay close to ``idiot``. Landmarks are strings of the sample; by Nyström
the kernel becomes the inner product of the vectors ``K(landmarks)^-1/2 K(landmarks, s)``, in
which a linear machine with squared hinge loss is fitted. As the kernel is a sum over
subsequences, so is the fitted machine: one weight per subsequence, 2^20 in all.

Text is folded to 32 signs: letters (accents go, but accented vowels are signs of
their own), one sign for other letters, one for everything between letters. Sentences end at
``.!?`` and line breaks; a unit is a word of a sentence, several single letters in a row are
one unit, and units of more than ``LONGEST`` signs are cut into overlapping ones. The score
of a sentence is that of its strongest unit, the score of a document that of its strongest
sentence, turned into a chance by a logistic curve.

Learning has labels of documents, which their sentences take over. Units that stand in far more
toxic documents than in others (``EVIDENCE`` standard errors) are the positive examples,
the heaviest ``VARIED`` of them also spaced out and with a sign put in. Negative examples are
units of the other documents: some of the smallest hash first, then, ``ROUNDS`` times, the
strongest ones left. Three quarters of the sample fit, one quarter calibrates. The sample
holds about ``SAMPLE_DOCS`` labelled documents of each class, those of the smallest hash of
doc_id, with all their text; the fit uses at most ``POSITIVES`` and ``NEGATIVES`` different
units, and ``HARD`` more a round.

Defined cases: null and empty texts, and those without a unit of four signs, score like a text
whose every unit is unknown. A doc_id labelled twice is toxic if one of its labels says so; a
label other than 0 and 1 is none. Without labels of both classes every score is the share
of toxic labels (0 without any). Repeated rows and rows without an id are scored like any
other; columns besides doc_id, text and toxic are ignored.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm.support import map_batches, materialise, texts_of

SPAN = 7
DECAY = 0.85
LONGEST = 24
STRIDE = 16
LANDMARKS = 256
COST = 1.5
ROUNDS = 3
SAMPLE_DOCS = 2500
EVIDENCE = 3.5
POSITIVES = 3000
NEGATIVES = 3000
HARD = 1500
VARIED = 150
THRESHOLD = 0.3
# Bytes of text that are taken apart at once.
PORTION = 1 << 18

_LENGTH = 4
_TABLE = 1 << 5 * _LENGTH
_OTHER = 31
_STOP = 32
# Places of the second to fourth sign of a subsequence, after the first.
_PLACES = list(itertools.combinations(range(1, SPAN), _LENGTH - 1))
_folds: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Sign of each code point below 0x250: 0 between letters, ``_STOP`` at a sentence's end."""
    if not _folds:
        accented = {"a": 27, "e": 28, "o": 29, "u": 30}
        table = np.zeros(0x250, dtype=np.uint8)
        for point in range(table.size):
            letter = chr(point).lower()
            base = unicodedata.normalize("NFD", letter)[0]
            if "a" <= base <= "z":
                plain = ord(base) - 96
                table[point] = plain if base == letter else accented.get(base, plain)
            elif letter.isalpha():
                table[point] = _OTHER
            elif letter in ".!?\n":
                table[point] = _STOP
        _folds.append(table)
    return _folds[0]


@dataclass(frozen=True)
class Units:
    """Units of several texts: signs in one array, unit by unit, with a 0 at both ends."""

    signs: np.ndarray
    start: np.ndarray
    size: np.ndarray
    text: np.ndarray
    sentence: np.ndarray

    def keys(self) -> np.ndarray:
        """A 64-bit hash of each unit's signs."""
        if not self.start.size:
            return np.zeros(0, dtype=np.uint64)
        place = np.arange(self.signs.size) - np.repeat(self.start, self.size)
        return np.add.reduceat((self.signs.astype(np.uint64) + 1) * _MIX[place], self.start)

    def take(self, which: np.ndarray) -> Units:
        size = self.size[which]
        start = np.cumsum(size) - size
        at = np.arange(int(size.sum())) + np.repeat(self.start[which] - start, size)
        return Units(self.signs[at], start, size, self.text[which], self.sentence[which])

    def strings(self) -> list[bytes]:
        raw = self.signs.astype(np.uint8).tobytes()
        return [
            raw[a : a + n] for a, n in zip(self.start.tolist(), self.size.tolist(), strict=True)
        ]


_MIX = np.random.default_rng(11).integers(1, 2**63, LONGEST + 2, dtype=np.uint64) * 2 + 1


def from_strings(strings: list[bytes]) -> Units:
    size = np.array([len(s) for s in strings], dtype=np.int64)
    none = np.zeros(size.size, dtype=np.int64)
    signs = np.frombuffer(b"".join(strings), dtype=np.uint8).astype(np.int32)
    return Units(signs, np.cumsum(size) - size, size, none, none)


def units_of(texts: list[bytes]) -> Units:
    """Units of UTF-8 texts. ``sentence`` numbers the sentences of all texts together."""
    wide = [t.decode("utf-8", "replace").encode("utf-32-le") for t in texts]
    chars = [np.frombuffer(w, dtype=np.uint32) for w in wide]
    of_text = np.repeat(np.arange(len(chars)), [c.size + 1 for c in chars])
    point = np.full(of_text.size, 10, dtype=np.uint32)
    at = 0
    for c in chars:
        point[at : at + c.size] = c
        at += c.size + 1
    fold = _fold()
    sign = np.where(point < fold.size, fold[np.minimum(point, fold.size - 1)], _OTHER)
    blank = (point <= 32) | (point == 0xA0)
    sentence = np.cumsum(sign == _STOP)
    sign[sign == _STOP] = 0
    letter = sign != 0
    if not letter.any():
        none = np.zeros(0, dtype=np.int64)
        return Units(none.astype(np.int32), none, none, none, none)
    # Words between blanks, from their first to their last letter, gaps of one sign.
    word = np.cumsum(blank)
    where = np.flatnonzero(letter)
    begins = np.ones(where.size, dtype=bool)
    begins[1:] = word[where[1:]] != word[where[:-1]]
    # Several single letters in a row are one word.
    first = np.flatnonzero(begins)
    count = np.diff(np.append(first, where.size))
    joined = (count[1:] == 1) & (count[:-1] == 1)
    joined &= sentence[where[first[1:]]] == sentence[where[first[:-1]]]
    begins[first[1:][joined]] = False
    gap = np.zeros(where.size, dtype=bool)
    gap[1:] = (where[1:] != where[:-1] + 1) & ~begins[1:]
    # Lay out letters, a 0 for each gap and one at either end of a word.
    width = 1 + gap + 2 * begins
    end = np.cumsum(width)
    laid = np.zeros(int(end[-1]) + 1, dtype=np.int32)
    laid[end - 1] = sign[where]
    # A word begins at the 0 before its first letter; the 0 before that closes the last word.
    first = np.flatnonzero(begins)
    start = end[first] - 2
    size = np.append(start[1:], laid.size) - start
    text, sentence = of_text[where[first]], sentence[where[first]]
    pieces = np.maximum(1, -(-(size - LONGEST - 2 + STRIDE) // STRIDE))
    pieces[size <= LONGEST + 2] = 1
    nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = np.repeat(start, pieces) + nth * STRIDE
    size = np.minimum(np.repeat(size, pieces) - nth * STRIDE, LONGEST + 2)
    cut = Units(laid, start, size, np.repeat(text, pieces), np.repeat(sentence, pieces))
    return cut.take(np.arange(start.size))


def _self_similarity() -> np.ndarray:
    """Square root of K(s, s) for each length, no subsequence occurring twice."""
    length = np.arange(LONGEST + 3)
    total = sum(np.maximum(length - p[-1], 0) * DECAY ** (2 * (p[-1] - 3)) for p in _PLACES)
    return np.sqrt(np.maximum(total, 1.0))


_NORM = _self_similarity()


def _left(units: Units) -> np.ndarray:
    """Signs from each place to the end of its unit."""
    place = np.arange(units.signs.size) - np.repeat(units.start, units.size)
    return np.repeat(units.size, units.size) - place


def occurrences(units: Units) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(places, subsequences there, weight) for every pattern of gaps."""
    s, left = units.signs, _left(units)
    for last in range(_LENGTH - 1, SPAN):
        at = np.flatnonzero(left > last)
        head, tail = s[at] << 15, s[at + last]
        inner = [s[at + k] for k in range(1, last)]
        for a, b in itertools.combinations(range(1, last), 2):
            yield at, head | inner[a - 1] << 10 | inner[b - 1] << 5 | tail, DECAY ** (last - 3)


def _per_unit(units: Units, value: np.ndarray) -> np.ndarray:
    if not units.start.size:
        return np.zeros(0)
    return np.add.reduceat(value, units.start) / _NORM[units.size]


@dataclass(frozen=True)
class Machine:
    """Weight per subsequence, offset, and the logistic curve over document scores."""

    weights: np.ndarray
    offset: float
    slope: float = 1.0
    middle: float = 0.0

    def scores(self, units: Units) -> np.ndarray:
        total = np.zeros(units.signs.size, dtype=np.float32)
        for at, sub, weight in occurrences(units):
            total[at] += self.weights[sub] * np.float32(weight)
        return _per_unit(units, total) + self.offset

    def chance(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(-(self.slope * score + self.middle), -60, 60)))


def kernel(units: Units, landmarks: Units) -> np.ndarray:
    """K between every unit and every landmark."""
    n = landmarks.start.size
    owner = np.repeat(np.arange(n), landmarks.size)
    theirs = [(owner[at], sub, np.float32(w)) for at, sub, w in occurrences(landmarks)]
    known = np.unique(np.concatenate([sub for _, sub, _ in theirs]))
    row = np.full(_TABLE, -1, dtype=np.int32)
    row[known] = np.arange(known.size)
    table = np.zeros((known.size, n), dtype=np.float32)
    for mark, sub, weight in theirs:
        np.add.at(table, (row[sub], mark), weight)
    holder = np.repeat(np.arange(units.start.size), units.size)
    out = np.zeros((units.start.size, n), dtype=np.float32)
    for at, sub, weight in occurrences(units):
        hit = np.flatnonzero(row[sub] >= 0)
        for lot in np.array_split(hit, max(1, hit.size // 8192)):
            if lot.size:
                unit = holder[at[lot]]
                first = np.flatnonzero(np.diff(unit, prepend=-1))
                part = np.add.reduceat(table[row[sub[lot]]], first, axis=0)
                out[unit[first]] += part * np.float32(weight)
    return out / _NORM[units.size][:, None] / _NORM[landmarks.size]


def fit(strings: list[bytes], toxic: np.ndarray, weight: np.ndarray) -> Machine:
    """The machine of these units; both classes weigh the same in total."""
    units = from_strings(strings)
    # Landmarks: the heaviest units, three of toxic sentences to each other one.
    heavy = np.argsort(-weight, kind="stable")
    marks = np.concatenate(
        [heavy[toxic[heavy]][: LANDMARKS * 3 // 4], heavy[~toxic[heavy]][: LANDMARKS // 4]]
    )
    landmarks = units.take(marks)
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    kept = values > values.max() * 1e-6
    root = vectors[:, kept] / np.sqrt(values[kept])
    x = kernel(units, landmarks) @ root
    x = np.hstack([x, np.ones((x.shape[0], 1))])
    sign = np.where(toxic, 1.0, -1.0)
    share = np.where(toxic, weight / weight[toxic].sum(), weight / weight[~toxic].sum())
    share = share * COST * sign.size / 2
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        margin = sign * (x @ w)
        inside = margin < 1
        xi, ci = x[inside], share[inside]
        slope = ridge @ w - xi.T @ (ci * sign[inside] * (1 - margin[inside]))
        step = np.linalg.solve(ridge + (xi.T * ci) @ xi, slope)
        w = w - step
        if np.abs(step).max() < 1e-7:
            break
    share_of = root @ w[:-1] / _NORM[landmarks.size]
    weights = np.zeros(_TABLE)
    owner = np.repeat(np.arange(marks.size), landmarks.size)
    for at, sub, factor in occurrences(landmarks):
        np.add.at(weights, sub, factor * share_of[owner[at]])
    return Machine(weights.astype(np.float32), float(w[-1]))


def variants(unit: bytes) -> dict[bytes, float]:
    """The unit spaced out, and with a gap or another letter put in at each place, and how
    much each form counts beside the unit itself."""
    inner = unit[1:-1]
    if not 4 <= len(inner) <= LONGEST // 2 or 0 in inner:
        return {}
    spaced = b"\0".join(inner[i : i + 1] for i in range(len(inner)))
    forms = {b"\0" + spaced + b"\0": 0.5}
    for at in range(1, len(inner)):
        letter = 1 + (sum(inner) * 7 + at * 5) % 26
        for sign in (0, letter):
            forms[b"\0" + inner[:at] + bytes([sign]) + inner[at:] + b"\0"] = 0.7
    return forms


def calibrated(machine: Machine, score: np.ndarray, toxic: np.ndarray, share: float) -> Machine:
    """With a logistic curve fitted to document scores; ``share`` of all documents is toxic."""
    n = np.array([(~toxic).sum(), toxic.sum()])
    if not n.all():
        return machine
    goal = np.where(toxic, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    weight = np.where(toxic, share / n[1], (1 - share) / n[0]) * toxic.size
    x = np.stack([score, np.ones_like(score)], axis=1)
    curve = np.array([1.0, 0.0])
    for _ in range(100):
        chance = 1 / (1 + np.exp(np.clip(-(x @ curve), -60, 60)))
        bend = (x.T * (weight * chance * (1 - chance))) @ x + 1e-3 * np.eye(2)
        slope = x.T @ (weight * (chance - goal)) + 1e-3 * (curve - [1.0, 0.0])
        step = np.linalg.solve(bend, slope)
        # Short steps: far from the goal the curve is flat.
        curve = curve - step / max(1.0, float(np.abs(step).max()) / 4)
        if np.abs(step).max() < 1e-7:
            break
    slope, middle = max(float(curve[0]), 1e-6), float(curve[1])
    return Machine(machine.weights, machine.offset, slope, middle)


# -- over tables ----------------------------------------------------------------


def held_out() -> Column:
    """Whether a document is kept away from learning."""
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(key % 4 == 2, F.lit(False))


def portions(texts: Iterator[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts by number, in lots of about ``PORTION`` bytes. Longer texts are cut after a word
    of two letters or more; one without any such place is cut anywhere."""
    rows: list[int] = []
    lot: list[bytes] = []
    held = 0
    for row, text in enumerate(texts):
        at = 0
        while True:
            end = len(text)
            if end - at > PORTION:
                place = _CUT.search(text, at + PORTION // 2, at + PORTION)
                end = place.end() if place else at + PORTION
            rows.append(row)
            lot.append(text[at:end])
            held += end - at
            if held >= PORTION // 2:
                yield rows, lot
                rows, lot, held = [], [], 0
            at = end
            if at >= len(text):
                break
    if lot:
        yield rows, lot


_CUT = re.compile(rb"[A-Za-z]{2}[ \n]")


def _sample_units(sample: DataFrame) -> DataFrame:
    """Distinct units of every document of the sample."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            toxic = batch.column(1).to_numpy(zero_copy_only=False)
            for rows, lot in portions(texts_of(batch)):
                units = units_of(lot)
                units = units.take(np.flatnonzero(units.size >= _LENGTH))
                if not units.start.size:
                    continue
                row = np.array(rows)[units.text]
                pair = np.stack([row.astype(np.uint64), units.keys()])
                _, one = np.unique(pair, axis=1, return_index=True)
                yield {
                    "doc_id": ids[row[one]],
                    "toxic": toxic[row[one]],
                    "unit": units.take(one).strings(),
                }

    rows = sample.select("doc_id", "toxic", "text")
    return map_batches(rows, step, "doc_id bigint, toxic int, unit binary").distinct()


def _scored(units: DataFrame, machine: Machine) -> DataFrame:
    """The rows with the score of their unit."""
    sent = units.sparkSession.sparkContext.broadcast(machine)
    names = units.columns

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(names)}
            strings = columns["unit"].to_pylist()
            yield {**columns, "score": sent.value.scores(from_strings(strings))}

    schema = [f"{f.name} {f.dataType.simpleString()}" for f in units.schema.fields]
    return map_batches(units, step, ", ".join([*schema, "score double"]))


@dataclass(frozen=True)
class Model:
    """A calibrated machine, or the one chance of every text where nothing could be learned."""

    machine: Machine | None
    share: float


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Model:
    """From the labels and texts of the documents that are not held out."""
    labelled = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    totals = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if len(totals) < 2:
        return Model(None, share)
    # A cut on the hash instead of a sort: what reaches the driver does not grow.
    spread = 1 << 30
    cut = {c: int(spread * min(1.0, SAMPLE_DOCS / n)) for c, n in totals.items()}
    limit = F.when(F.col("toxic") == 1, cut[1]).otherwise(cut[0])
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(spread)) < limit)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    units = materialise(spark, _sample_units(sample), "toxic_units")
    aside = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0
    fitted = units.where(~aside)
    n = {
        r["toxic"]: r["n"]
        for r in fitted.groupBy("toxic").agg(F.count_distinct("doc_id").alias("n")).collect()
    }
    if len(n) < 2:
        return Model(None, share)
    counts = (
        fitted.groupBy("unit")
        .agg(F.sum("toxic").alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))
        .withColumns({"pa": F.col("a") / n[1], "pb": F.col("b") / n[0]})
        .withColumn("p", (F.col("a") + F.col("b") + 1) / F.lit(n[1] + n[0] + 1))
        .withColumn("z", F.expr(f"(pa - pb) / sqrt(p * (1 - p) * {1 / n[1] + 1 / n[0]} + 1e-12)"))
        .withColumn("_up", (F.col("z") >= EVIDENCE) & F.expr("pa >= 3 * pb"))
        .select("unit", "a", "b", "z", "_up")
    )
    counted = materialise(spark, counts, "toxic_counts")
    up = counted.where("_up").orderBy(F.desc("z"), "unit").limit(POSITIVES).collect()
    down = counted.where("not _up and b > 0").select("unit")
    low = {
        bytes(r["unit"])
        for r in down.orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVES).collect()
    }
    if not up or not low:
        return Model(None, share)
    # bytes(): a binary value is a bytearray.
    good = {bytes(r["unit"]): float(r["a"]) ** 0.5 for r in up}
    for r in up[:VARIED]:
        for form, share_of_unit in variants(bytes(r["unit"])).items():
            good.setdefault(form, share_of_unit * float(r["a"]) ** 0.5)
    for turn in range(ROUNDS + 1):
        strings = [*good, *sorted(low)]
        toxic = np.arange(len(strings)) < len(good)
        weight = np.array([*good.values(), *[1.0] * len(low)])
        machine = fit(strings, toxic, weight)
        if turn < ROUNDS:
            hard = _scored(down, machine).orderBy(F.desc("score"), "unit")
            found = [bytes(r["unit"]) for r in hard.limit(HARD + len(low)).collect()]
            low |= set([u for u in found if u not in low][:HARD])
    tried = (
        _scored(units.where(aside), machine)
        .groupBy("doc_id", "toxic")
        .agg(F.greatest(F.max("score"), F.lit(machine.offset)).alias("score"))
        .collect()
    )
    score = np.array([r["score"] for r in tried])
    return Model(calibrated(machine, score, np.array([r["toxic"] == 1 for r in tried]), share), share)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row."""
    if model.machine is None:
        return docs.select("doc_id", F.lit(model.share).cast("double").alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model.machine)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        machine = sent.value
        for batch in batches:
            best = np.full(batch.num_rows, machine.offset)
            for rows, lot in portions(texts_of(batch)):
                units = units_of(lot)
                # Equal units are scored once.
                _, one, each = np.unique(units.keys(), return_index=True, return_inverse=True)
                score = machine.scores(units.take(one))[each]
                np.maximum.at(best, np.array(rows)[units.text], score)
            yield {"doc_id": batch.column(0), "score": machine.chance(best)}

    return map_batches(docs.select("doc_id", "text"), step, "doc_id bigint, score double")


def report(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and verdict of every document, learned from those that are not held out."""
    scored = score_texts(docs, learn(spark, docs, labels))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
