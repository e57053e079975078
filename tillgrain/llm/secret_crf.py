"""Secrets in texts: fixed patterns, and a linear-chain conditional random field.

The field tags every token of a text as beginning a secret, inside one or outside. A token is
a run of letters, digits and ``+/_.-`` or any other single character that is not a blank; a
whole text is one chain. Features are the token's shape (length, alphabet, digits, entropy,
changes of character class) and its surroundings: what the tokens beside it are, the blanks
between them, and whether a key word and a sign stand before it. All of them are numbers looked
up per distinct token, so that a batch of texts is scored at once.

Decoding is exact. A token whose score as outside is ahead by more than any change of steps
around it could bring back is outside in every best path; the chain falls apart there, and
Viterbi runs over the tokens in between.

Weights are fitted on the driver by gradient ascent on the conditional likelihood
(forward-backward sums) from two bounded samples, the ``SAMPLE_ROWS`` texts of the smallest
hash of doc_id among those with a match of the patterns and among all. A text gives up to four
windows of at most ``WINDOW`` tokens: two around spans of the patterns, one around another
token that is no plain word, one anywhere. Equal windows are counted, and at most ``20 *
SAMPLE_ROWS`` of them, those of the smallest hash, are sent to the driver. Tags come from the
fixed patterns, of an assignment from its value. What stands after a key word and a sign and
is no plain word, but no match either, is neither right nor wrong for learning: windows end
there. The field leaves the patterns' spans as they are and adds spans beside them. There is
no shuffle besides that of the sample.

Defined cases: a null text is an empty one and has no span. Repeated rows and rows
without an id are scanned like any other. Columns besides doc_id and text are ignored.
Without a training window the field adds nothing.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrain.llm.support import importable, map_batches

SAMPLE_ROWS = 4000
KINDS = ("assign", "access", "hex")
ADDED = "tagged"

# Fixed patterns. A run that is too short has no longer run inside it, so the bounds of
# access and hex can stand in the pattern; a short assignment still takes up its text.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_LENGTH = 12
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")

# What a text with a match holds, for Spark.
_LIKELY = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{14}|[0-9a-f]{16}"""
)

BLANKS = " \t\n\v\f\r"
# Blanks and the token after them; the tokens of a text without its last blanks cover it.
_TOKEN = re.compile(
    r"[\x20\x09-\x0D]*+(?:[A-Za-z0-9+/]{16,}+={1,2}(?![\w+/.=-])"
    r"|[\w+/-]++(?:\.++[\w+/-]++)*+|[^\x20\x09-\x0D])"
)
_CLASSES = re.compile(r"[A-Z]+|[a-z]+|[0-9]+|[^A-Za-z0-9]+")
_KEY = re.compile(
    r"(?:^|[_.-])(?:(?:api|access|private|auth)?_?keys?|pass(?:word|wd|phrase|code)?s?|pwd|pw|secrets?"
    r"|(?:auth)?tokens?|auth|authorization|cred(?:ential)?s?|bearer)$",
    re.IGNORECASE | re.ASCII,
)
_PLAIN = re.compile(r"[^\W\d_]?(?:[^\W\dA-Z_]|['-])*")
_NUMBER = re.compile(r"[0-9.+/-]+")

# Kinds of neighbours.
ROLES = (
    "edge", "word", "name", "number", "key", "mixed", "long", "sign", "quote", "open", "mark",
)
EDGE, WORD, NAME, NUMBER, KEY, MIXED, LONG, SIGN, QUOTE, OPEN, MARK = range(len(ROLES))
_SIGNS = {"=": SIGN, ":": SIGN, '"': QUOTE, "'": QUOTE, "`": QUOTE, "(": OPEN, "<": OPEN, "[": OPEN}
LONG_TOKEN, WORD_LENGTH = 12, 8

WINDOW, SIDE = 16, 3
# Tokens remembered with their kind, and the longest of them.
KNOWN_TOKENS, KNOWN_LENGTH = 200_000, 40
# Characters of texts that are scored at once.
BATCH_CHARACTERS = 1_000_000

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
Span = tuple[int, int, str, int]


def base_spans(text: str) -> list[Span]:
    """(start, place of the kind, kind, end) of the fixed patterns, in order."""
    found = [
        (m.start(), 0, "assign", m.end())
        for m in _ASSIGN.finditer(text)
        if m.end(2) - m.start(2) >= _ASSIGN_LENGTH
    ]
    found += [(m.start(), 1, "access", m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, "hex", m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _bucket(value: float, bounds: tuple[float, ...]) -> int:
    return sum(value >= b for b in bounds)


def _entropy(token: str) -> float:
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values())


def _plain(token: str) -> bool:
    """Whether a token is an ordinary word, a number or too short to tell."""
    return len(token) < WORD_LENGTH or bool(_PLAIN.fullmatch(token) or _NUMBER.fullmatch(token))


def _role(token: str) -> int:
    if len(token) == 1 and not token.isalnum():
        return _SIGNS.get(token, MARK)
    if len(token) <= KNOWN_LENGTH and _KEY.search(token):
        return KEY
    if _NUMBER.fullmatch(token):
        return NUMBER
    if _PLAIN.fullmatch(token):
        return NAME if token[0].isupper() else WORD
    return LONG if len(token) >= LONG_TOKEN else MIXED


def _shape(token: str) -> list[str]:
    if len(token) == 1 and not token.isalnum():
        return ["mark"]
    if len(token) < WORD_LENGTH:
        return ["short"]
    if _PLAIN.fullmatch(token):
        return ["plain", f"length={_bucket(len(token), (12, 16, 18, 20, 24, 32, 40, 64))}"]
    if _NUMBER.fullmatch(token):
        length, points = _bucket(len(token), (12, 16, 18, 20, 24, 32)), _bucket(token.count("."), (1, 3))
        return ["number", f"number={length}", f"points={points}", f"strokes={'-' in token}"]
    runs = _CLASSES.findall(token)
    kinds = {"A" if r[0].isupper() else "a" if r[0].islower() else "0" if r[0].isdigit() else "." for r in runs}
    digits = sum(c.isdigit() for c in token) / len(token)
    alphabet = "".join(sorted(kinds))
    if not set(token) - set("0123456789abcdef"):
        alphabet = "hex"
    elif not set(token) - set("0123456789ABCDEF"):
        alphabet = "HEX"
    return [
        f"alphabet={alphabet}",
        f"length={_bucket(len(token), (12, 16, 18, 20, 24, 32, 40, 64))}",
        f"digits={_bucket(digits, (0.1, 0.25, 0.5, 0.75, 1))}",
        f"entropy={_bucket(_entropy(token), (2, 2.5, 3, 3.5, 4, 4.5))}",
        f"changes={_bucket(len(runs) / len(token), (0.1, 0.2, 0.3, 0.5))}",
        f"alphabet+long={alphabet}{len(token) >= 16}",
        f"dots={_bucket(token.count('.'), (1, 3))}",
    ]


class Kinds(dict):
    """Number of the kind of each token: its shape, its role and whether blanks precede it."""

    def __init__(self) -> None:
        super().__init__()
        self.shapes: list[tuple[str, ...]] = [()]
        self.roles = [EDGE]
        self.blanks = [1]
        self._numbers: dict[tuple, int] = {}

    def __missing__(self, token: str) -> int:
        own = token.lstrip(BLANKS)
        shape, role, blank = tuple(_shape(own)), _role(own), int(len(own) < len(token))
        kind = self._numbers.setdefault((shape, role, blank), len(self.roles))
        if kind == len(self.roles):
            self.shapes.append(shape)
            self.roles.append(role)
            self.blanks.append(blank)
        if len(token) <= KNOWN_LENGTH:
            if len(self) >= KNOWN_TOKENS:
                self.clear()
            self[token] = kind
        return kind


def tokens(text: str) -> list[str]:
    """Every token with the blanks before it."""
    return _TOKEN.findall(text.rstrip(BLANKS))


def bounds(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each token without its blanks."""
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
    own = np.fromiter((len(w.lstrip(BLANKS)) for w in words), dtype=np.int64, count=len(words))
    return ends - own, ends


# Categories of a token's surroundings and how many values each has.
SLOTS = {
    "before": len(ROLES), "second": len(ROLES), "after": len(ROLES), "keyed": 4, "blanks": 4,
    "keyed+role": 4 * len(ROLES),
}


def _earlier(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    out[by:] = values[:-by]
    return out


def surroundings(roles: np.ndarray, blanks: np.ndarray) -> dict[str, np.ndarray]:
    """Value of each slot for every token; two edges stand on both sides of a text.

    ``keyed`` is 2 after a key word and a sign, with or without quotes, 1 after a key word
    alone and 3 after a sign alone.
    """
    after = np.zeros_like(roles)
    after[:-1] = roles[1:]
    next_blank = np.ones_like(blanks)
    next_blank[:-1] = blanks[1:]
    before = _earlier(roles, 1)
    named = (before == KEY) | ((before == QUOTE) & (_earlier(roles, 2) == KEY))
    assigned = (before == SIGN) & _earlier(named, 1)
    assigned |= (before == QUOTE) & _earlier(assigned, 1)
    signed = (before == SIGN) | ((before == QUOTE) & (_earlier(roles, 2) == SIGN))
    keyed = np.where(assigned, 2, np.where(named, 1, np.where(signed, 3, 0)))
    return {
        "before": before,
        "second": _earlier(roles, 2),
        "after": after,
        "keyed": keyed,
        "blanks": 2 * blanks + next_blank,
        "keyed+role": keyed * len(ROLES) + roles,
    }


def tags_of(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tags of the tokens that touch one of the ordered spans."""
    tags = np.full(starts.size, OUTSIDE)
    for a, b in spans:
        first, last = np.searchsorted(ends, a, "right"), np.searchsorted(starts, b, "left")
        if first < last and not tags[first]:
            tags[first] = BEGIN
            tags[first + 1 : last] = INSIDE
    return tags


def windows(text: str, kinds: Kinds) -> list[tuple[list[str], list[int]]]:
    """Features (tab-joined per token) and tags of the windows that a text gives to learning."""
    words = tokens(text)
    if not words:
        return []
    numbers = np.array([0, 0, *map(kinds.__getitem__, words), 0, 0])
    roles, blanks = np.array(kinds.roles)[numbers], np.array(kinds.blanks)[numbers]
    slots = {k: v[2:-2] for k, v in surroundings(roles, blanks).items()}
    starts, ends = bounds(words)
    values = sorted(_values(text))
    tags = tags_of(starts, ends, values)
    doubtful = (slots["keyed"] == 2) & (tags == OUTSIDE)
    for i in np.flatnonzero(doubtful):
        doubtful[i] = not _plain(words[i].lstrip(BLANKS))
    own = roles[2:-2]

    def picked(places: np.ndarray, number: int) -> list[int]:
        at = [(zlib.crc32(f"{i}:{words[i]}".encode("utf-8", "replace")), int(i)) for i in places]
        return [i for _, i in sorted(at)[:number]]

    plain = (tags == OUTSIDE) & ~doubtful
    odd = plain & np.isin(own, (NUMBER, MIXED, LONG, KEY))
    centres = picked(np.flatnonzero(tags == BEGIN), 2)
    centres += picked(np.flatnonzero(odd), 1)
    anywhere = np.flatnonzero(plain)
    if anywhere.size:
        centres.append(int(anywhere[zlib.crc32(text[:1000].encode("utf-8", "replace")) % anywhere.size]))
    out = []
    for centre in centres:
        low = centre
        while low > 0 and centre - low < SIDE and not doubtful[low - 1]:
            low -= 1
        while low > 0 and tags[low] == INSIDE and centre - low < WINDOW // 2:
            low -= 1
        high = centre + 1
        while high < len(words) and not doubtful[high] and high - low < WINDOW:
            if high - centre > SIDE and tags[high] != INSIDE:
                break
            high += 1
        own_tags = tags[low:high].tolist()
        # A window that begins within a span has it begin there.
        if own_tags[0] == INSIDE:
            own_tags[0] = BEGIN
        names = [
            "\t".join(
                [*kinds.shapes[numbers[i + 2]], *(f"{k}={v[i]}" for k, v in slots.items()), "any"]
            )
            for i in range(low, high)
        ]
        out.append((names, own_tags))
    return out


def _values(text: str) -> list[tuple[int, int]]:
    """Spans of the fixed patterns, of assignments only the value."""
    found = [
        m.span(2) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= _ASSIGN_LENGTH
    ]
    found += [m.span() for m in _ACCESS.finditer(text)]
    return found + [m.span() for m in _HEX.finditer(text)]


# -- the field -------------------------------------------------------------------


class Field:
    """Weights of features per tag, and of steps between tags (the start as fourth)."""

    def __init__(self, names: list[str]) -> None:
        self.index = {name: i for i, name in enumerate(names)}
        self.emit = np.zeros((len(names), 3))
        self.step = np.zeros((4, 3))

    def scores(self, chain: list[list[str]]) -> np.ndarray:
        index = self.index
        return np.array(
            [self.emit[[index[n] for n in names if n in index]].sum(axis=0) for names in chain]
        )

    def decode(self, chain: list[list[str]]) -> list[int]:
        """Best tags by Viterbi; inside only follows begin or inside. Ties go outside."""
        return best_path(self.scores(chain).tolist(), self.step.tolist(), 3)


def best_path(
    rows: list[list[float]], step: list[list[float]], before: int, then_outside: bool = False
) -> list[int]:
    """Best tags of a run of tokens after a tag (3: the start), maybe before one outside."""
    (oo, ob, _), (bo, bb, bi), (io, ib, ii) = step[:3]
    first = step[before]
    o, b = first[OUTSIDE] + rows[0][OUTSIDE], first[BEGIN] + rows[0][BEGIN]
    i = first[INSIDE] + rows[0][INSIDE] if before in (BEGIN, INSIDE) else -math.inf
    back = []
    for to_o, to_b, to_i in rows[1:]:
        from_o = OUTSIDE if o + oo >= b + bo and o + oo >= i + io else BEGIN if b + bo >= i + io else INSIDE
        from_b = OUTSIDE if o + ob >= b + bb and o + ob >= i + ib else BEGIN if b + bb >= i + ib else INSIDE
        from_i = BEGIN if b + bi >= i + ii else INSIDE
        back.append((from_o, from_b, from_i))
        o, b, i = (
            max(o + oo, b + bo, i + io) + to_o,
            max(o + ob, b + bb, i + ib) + to_b,
            max(b + bi, i + ii) + to_i,
        )
    if then_outside:
        o, b, i = o + oo, b + bo, i + io
    tags = [OUTSIDE if o >= b and o >= i else BEGIN if b >= i else INSIDE]
    for origin in reversed(back):
        tags.append(origin[tags[-1]])
    return tags[::-1]


class Tagger:
    """The field's tags for whole texts, many at once."""

    def __init__(self, field: Field) -> None:
        self.field, self.kinds = field, Kinds()
        self.shape_scores = np.zeros((0, 3))
        self.slot_scores = {
            slot: np.array([self._weight(f"{slot}={v}") for v in range(size)])
            for slot, size in SLOTS.items()
        }
        self.step = field.step.tolist()
        s = field.step
        # The most that steps could gain by a tag other than outside, against outside and,
        # where the next token was inside, that one beginning instead.
        enter = max(s[0, BEGIN] - s[0, OUTSIDE], s[3, BEGIN] - s[3, OUTSIDE],
                    *(s[p, y] - s[p, OUTSIDE] for p in (1, 2) for y in (1, 2)))
        leave = max(s[y, n] - s[OUTSIDE, BEGIN if n == INSIDE else n] for y in (1, 2) for n in range(3))
        again = max(s[INSIDE, n] - s[BEGIN, n] for n in range(3))
        self.gain = float(enter + max(0.0, leave) + max(0.0, again))

    def _weight(self, name: str) -> np.ndarray:
        at = self.field.index.get(name)
        return np.zeros(3) if at is None else self.field.emit[at]

    def scores(self, numbers: np.ndarray) -> np.ndarray:
        """Score of each tag for every token of texts between edges."""
        kinds = self.kinds
        known = len(self.shape_scores)
        if known < len(kinds.shapes):
            more = [
                sum((self._weight(n) for n in shape), self._weight("any"))
                for shape in kinds.shapes[known:]
            ]
            self.shape_scores = np.concatenate([self.shape_scores, np.array(more)])
        out = self.shape_scores[numbers]
        slots = surroundings(np.array(kinds.roles)[numbers], np.array(kinds.blanks)[numbers])
        for slot, values in slots.items():
            out += self.slot_scores[slot][values]
        out[numbers == 0] = 0
        return out

    def tagged(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """Start and end of the field's secrets in each text."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not self.field.index:
            return out
        numbers, places, words_of = [0, 0], [], []
        for text in texts:
            words = tokens(text)
            words_of.append(words)
            places.append(len(numbers))
            numbers += map(self.kinds.__getitem__, words)
            numbers += (0, 0)
        numbers = np.array(numbers)
        scores = self.scores(numbers)
        other = scores[:, 1:].max(axis=1)
        again = np.zeros(len(scores))
        again[:-1] = np.maximum(0, scores[1:, INSIDE] - scores[1:, BEGIN])
        open_ = np.flatnonzero((scores[:, OUTSIDE] - other <= self.gain + again) & (numbers > 0))
        if open_.size == 0:
            return out
        runs = np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1)
        edges = numbers == 0
        texts_of = np.searchsorted(places, [run[0] for run in runs], "right") - 1
        limits: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for run, k in zip(runs, texts_of.tolist(), strict=True):
            low, high = int(run[0]), int(run[-1]) + 1
            before = 3 if edges[low - 1] else OUTSIDE
            tags = best_path(scores[low:high].tolist(), self.step, before, not edges[high])
            if not any(tags):
                continue
            if k not in limits:
                limits[k] = bounds(words_of[k])
            starts, ends = limits[k]
            for i, tag in enumerate(tags, low - places[k]):
                if tag == BEGIN:
                    out[k].append((int(starts[i]), int(ends[i])))
                elif tag == INSIDE:
                    out[k][-1] = (out[k][-1][0], int(ends[i]))
        return out

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """Fixed spans, and the field's spans that touch none of them, in order."""
        out: list[list[Span]] = []
        for part in _parts(texts):
            for text, found in zip(part, self.tagged(part), strict=True):
                base = base_spans(text)
                added = [(a, len(KINDS), ADDED, b) for a, b in found]
                out.append(sorted(base + _beside(added, base)))
        return out


def _beside(added: list[Span], base: list[Span]) -> list[Span]:
    """The added spans that touch no fixed one."""
    if not added or not base:
        return added
    # Ends reached by the fixed spans that start no later.
    starts = [s[0] for s in base]
    reach = np.maximum.accumulate([s[3] for s in base])
    last = np.searchsorted(starts, [s[3] for s in added], "left") - 1
    return [s for s, k in zip(added, last.tolist(), strict=True) if k < 0 or reach[k] <= s[0]]


def _parts(texts: list[str]) -> Iterator[list[str]]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text)
        if size >= BATCH_CHARACTERS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(
    rows: list[tuple[list[list[str]], list[int]]],
    rounds: int = 200,
    l2: float = 0.5,
    counts: list[int] | None = None,
) -> Field:
    """Maximise the conditional log-likelihood of the tags less an L2 penalty; a row counts once
    or as often as ``counts`` says."""
    names = sorted({n for chain, _ in rows for token in chain for n in token})
    field = Field(names)
    by_length: dict[int, list] = {}
    for (chain, tags), n in zip(rows, counts or [1] * len(rows), strict=True):
        by_length.setdefault(len(chain), []).append((chain, tags, n))
    batches = []
    for length, own in by_length.items():
        x = np.zeros((len(own), length, len(names)), dtype=np.float32)
        for i, (chain, _, _) in enumerate(own):
            for t, token in enumerate(chain):
                x[i, t, [field.index[n] for n in token]] = 1
        batches.append((x, np.array([o[1] for o in own]), np.array([float(o[2]) for o in own])))
    weights = [field.emit, field.step]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    for k in range(1, rounds + 1 if rows else 1):
        slopes = [-l2 * w for w in weights]
        for x, tags, n in batches:
            _add_slope(x, tags, n, weights, slopes)
        for w, g, (m, v) in zip(weights, slopes, moments, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return field


def _add_slope(
    x: np.ndarray, tags: np.ndarray, counts: np.ndarray, weights: list, slopes: list
) -> None:
    """Observed less expected feature counts, by forward and backward sums."""
    emit, step = weights
    n, length, _ = x.shape
    scores = (x @ emit.astype(np.float32)).astype(np.float64)
    forward = [step[3] + scores[:, 0]]
    for t in range(1, length):
        forward.append(_log_sum(forward[-1][:, :, None] + step[:3], 1) + scores[:, t])
    backward = [np.zeros((n, 3))]
    for t in range(length - 1, 0, -1):
        backward.append(_log_sum(step[:3] + (scores[:, t] + backward[-1])[:, None, :], 2))
    backward.reverse()
    total = _log_sum(forward[-1], 1)
    one = np.eye(3)[tags]
    for t in range(length):
        chance = np.exp(forward[t] + backward[t] - total[:, None])
        off = (one[:, t] - chance) * counts[:, None]
        slopes[0] += x[:, t].T @ off.astype(np.float32)
        if t == 0:
            slopes[1][3] += off.sum(axis=0)
            continue
        pair = forward[t - 1][:, :, None] + step[:3] + (scores[:, t] + backward[t])[:, None, :]
        expected = np.exp(pair - total[:, None, None])
        steps = one[:, t - 1, :, None] * one[:, t, None, :] - expected
        slopes[1][:3] += (steps * counts[:, None, None]).sum(axis=0)


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS) -> Field:
    """Fit on the windows of two bounded samples of texts."""

    def first(texts: DataFrame) -> DataFrame:
        hashed = texts.select("doc_id", F.xxhash64("doc_id").alias("_h"))
        return hashed.orderBy("_h", "doc_id").limit(rows).select("doc_id")

    ids = first(docs.where(F.col("text").rlike(_LIKELY))).unionByName(first(docs)).distinct()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        kinds = Kinds()
        for batch in batches:
            out = [w for text in batch.column(1).to_pylist() for w in windows(text or "", kinds)]
            yield {
                "names": pa.array([n for n, _ in out], pa.list_(pa.string())),
                "tags": pa.array([t for _, t in out], pa.list_(pa.int32())),
            }

    sample = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text")
    chained = map_batches(sample, step, "names array<string>, tags array<int>")
    counted = chained.groupBy("names", "tags").agg(F.count(F.lit(1)).alias("n"))
    order = [F.xxhash64("names", "tags"), F.col("names"), F.col("tags")]
    training = sorted(
        (tuple(r["names"]), tuple(r["tags"]), r["n"])
        for r in counted.orderBy(*order).limit(20 * rows).collect()
    )
    if not any(any(tags) for _, tags, _ in training):
        return Field([])
    chains = [([n.split("\t") for n in names], list(tags)) for names, tags, _ in training]
    return fit(chains, counts=[n for _, _, n in training])


def spans_of(text: str, field: Field) -> list[Span]:
    """Fixed spans, and the field's spans that touch none of them, in order."""
    return Tagger(field).spans([text])[0]


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, spans): all spans of each text, as structs of kind, start, end, base."""
    kind = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tagger = Tagger(field)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            rows = [
                [{"kind": k, "start": a, "end": b, "base": k != ADDED} for a, _, k, b in spans]
                for spans in tagger.spans(texts)
            ]
            yield {"doc_id": batch.column(0), "spans": pa.array(rows, pa.list_(kind))}

    return map_batches(
        docs.select("doc_id", "text"),
        step,
        "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>",
    )


def report(scanned: DataFrame) -> DataFrame:
    """Counts per fixed kind, a digest of the fixed spans, and all spans as text."""

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str):
        own = F.filter("spans", lambda s: s["kind"] == kind)
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    fixed = F.filter("spans", lambda s: s["base"])
    return scanned.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(joined(fixed), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, field: Field, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by the mark."""
    at = docs.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def masked(text: str | None, spans: list[Span]) -> str | None:
        done, parts = 0, []
        for start, _, _, end in spans:
            if start >= done:
                parts += [text[done:start], mark]
            done = max(done, end)
        return "".join([*parts, text[done:]]) if parts else text

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field)
        for batch in batches:
            columns = list(batch.columns)
            texts = columns[at].to_pylist()
            spans = tagger.spans([t or "" for t in texts])
            columns[at] = pa.array(map(masked, texts, spans), pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    importable(docs.sparkSession)
    return docs.mapInArrow(step, schema)
