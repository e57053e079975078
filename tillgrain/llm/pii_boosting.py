"""Personal data: fixed patterns, and candidates selected by gradient-boosted trees.

All of it is DataFrame functions. Fixed patterns give the base spans. Generators of
wider patterns propose spans that may overlap; their format (length, digits, groups,
signs, checksum) and context (words before, characters on both sides) are whole-number
features, scored by boosted trees that stand in the plan as CASE expressions. Of the
candidates above their generator's threshold, those that touch no base span are added,
leftmost first.

The trees are fitted on the driver from all candidates: Spark counts those of equal features
and label, and one weighted row for each such group goes there. Right are base spans, and candidates beside them with evidence that the base
patterns do not use: a number of a telephone's length after a word that announces one, an
address whose dot is spelled out before a common top-level domain, a number with a card's
first digit and check digit in dotted groups or after a word for cards. Candidates that overlap
a base span without being one can never be added and are left out. Half of the candidates, by
hash, fit the trees; the other half sets each generator's threshold: the lowest score from which on at least
``PRECISION`` of its candidates are right. A generator without such a score, or with fewer than
``LEAST_SEEN`` candidates above it, adds nothing.

Texts are read once to learn and once to select, and never shuffled. Patterns are written
without nested repetition, so their cost stays in proportion to long texts: separators
inside a number, or dots inside a domain, are first replaced by a mark of the same length.

Defined cases: a null text is an empty one and has no span. Repeated rows and rows
without an id are handled like any other. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrain.llm import boosted_trees
from tillgrain.llm.support import materialise

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.99
LEAST_SEEN = 8
CONTEXT = 24
_BLOCK = 128
# Stands for a separator; a text's own such character is replaced by its neighbour first.
_MARK, _OTHER = "\x01", "\x02"

_LOCAL = r"A-Za-z0-9._%+\x01-"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def sums_before(values: Column) -> Column:
    """For each element the sum of those before it; sums of blocks keep it near linear."""

    def with_blocks(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), ((F.size(v) - 1) / _BLOCK).cast("int"))
        totals = F.transform(blocks, lambda b: _sum(F.slice(v, b * _BLOCK + 1, _BLOCK)))
        before = let(
            totals, lambda t: F.transform(t, lambda _, b: _sum(F.slice(t, F.lit(1), b)))
        )

        return let(
            before,
            lambda sums: F.transform(
                v,
                lambda _, i: F.get(sums, (i / _BLOCK).cast("int"))
                + _sum(F.slice(v, (i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK)),
            ),
        )

    return F.when(F.size(values) > 0, let(values, with_blocks)).otherwise(
        F.array().cast("array<int>")
    )


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as structs of start, end, m (in characters).

    What lies between the matches comes from a split by the same pattern; lengths of
    both, added up, give the places.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(m: Column) -> Column:
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(m)), m, lambda g, x: g + F.length(x))
        # A match ends where the gaps and matches up to it end.
        ends = let(steps, lambda s: F.zip_with(sums_before(s), s, lambda a, b: a + b))
        return F.zip_with(
            ends,
            m,
            lambda e, x: F.struct(
                (e - F.length(x)).cast("bigint").alias("start"),
                e.cast("bigint").alias("end"),
                x.alias("m"),
            ),
        )

    return let(found, placed)


_NONE = "array<struct<start:bigint,end:bigint,m:string>>"


def _gated(gate: Column, spans: Column) -> Column:
    return F.when(gate, spans).otherwise(F.array().cast(_NONE))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit is the check digit of the others."""

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.when(F.length(digits) > 0, F.aggregate(places, F.lit(0), add) % 10 == 0).otherwise(
        F.lit(False)
    )


def _marked(text: Column, separator: str) -> Column:
    return F.regexp_replace(F.translate(text, _MARK, _OTHER), separator, _MARK)


def base_spans(text: Column) -> dict[str, Column]:
    """Per kind the valid matches of its fixed pattern."""
    domain_dots = _marked(text, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])")
    email = matches(
        domain_dots,
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]+\x01[A-Za-z0-9\x01-]+",
    )
    ip = matches(text, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
    number = matches(_marked(text, r"(?<=[0-9])[\x20-](?=[0-9])"), r"[0-9][0-9\x01]{13,}")
    phone = matches(text, r"\+[0-9][\x20().0-9-]+[0-9]")
    long_number = text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}")
    count = lambda c: F.length(_digits(c["m"]))
    return {
        "email": _gated(F.instr(text, "@") > 0, email),
        "ip": _gated(
            text.rlike(r"[0-9]\.[0-9]+\.[0-9]"),
            F.filter(ip, lambda c: c["m"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")),
        ),
        "card": _gated(
            long_number,
            F.filter(number, lambda c: count(c).between(14, 19) & luhn(_digits(c["m"]))),
        ),
        "phone": _gated(
            text.rlike(r"\+[0-9]"), F.filter(phone, lambda c: count(c).between(10, 15))
        ),
    }


# -- candidates --------------------------------------------------------------------


@dataclass(frozen=True)
class Generator:
    kind: str
    gate: str
    pattern: str
    # Words that announce such data.
    hints: str


_AT = r"\x20?(?:@|[(\[]at[)\]]|\x20at\x20)\x20?"
_DOT = r"\x20?(?:\.|[(\[]dot[)\]]|\x20dot\x20)\x20?"
GENERATORS = (
    Generator("email", r"@|[(\[]at[)\]]|[(\[]dot[)\]]|\x20dot\x20", rf"[A-Za-z0-9._%+-]{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{2,63}}){{1,4}}", "mail|contact|write"),
    Generator("ip", r"[0-9]\.[0-9]{1,3}\.[0-9]", r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}", "host|server|addr"),
    Generator("card", r"[0-9](?:[\x20.-]?[0-9]){12}", r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}", "card|visa|pay|account"),
    Generator("phone", r"[0-9][0-9().\x20-]{5,}[0-9]", r"[+(]{0,2}(?<![0-9])[0-9][0-9().\x20-]{6,18}[0-9]", "tel|phone|call|fax|mobile"),
)
_SPELLED_DOT = r"[(\[]dot[)\]]|\x20dot\x20"
# Top-level domains common enough to tell a spelled-out address from prose.
_COMMON_END = r"(?:com|org|net|edu|gov|info)$"
FEATURES = (
    "generator", "length", "digits", "groups", "longest", "spelled", "first", "brackets", "dots", "dashes",
    "spaces", "letters", "luhn", "parts", "hint", "before", "after",
)


def _side(c: Column) -> Column:
    return (
        F.when(F.coalesce(c, F.lit("")) == "", 0)
        .when(c.rlike(r"\s"), 1)
        .when(c.rlike("[0-9]"), 2)
        .when(c.rlike(r"\p{L}"), 3)
        .otherwise(4)
    )


def _features(generator: int, c: Column, text: Column) -> Column:
    """Whole-number features of one candidate, in the order of FEATURES."""
    m = c["m"]
    digits = _digits(m)
    before = F.substring(
        text, F.greatest(c["start"] - CONTEXT + 1, F.lit(1)).cast("int"), F.least(c["start"], F.lit(CONTEXT)).cast("int")
    )
    sign = lambda s: F.length(m) - F.length(F.regexp_replace(m, s, ""))
    groups = F.filter(F.split(m, "[^0-9]+"), lambda g: g != "")
    named = {
        "generator": F.lit(generator),
        "length": F.length(m),
        "digits": F.length(digits),
        "groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        # An address with a spelled-out dot and a common ending.
        "spelled": (m.rlike(_SPELLED_DOT) & m.rlike(_COMMON_END)).cast("int"),
        "first": F.coalesce(F.substring(digits, 1, 1).try_cast("int"), F.lit(-1)),
        "brackets": sign("[()]"),
        "dots": sign(r"\."),
        "dashes": sign("-"),
        "spaces": sign(r"\x20"),
        "letters": sign("[A-Za-z]"),
        "luhn": luhn(digits).cast("int"),
        "parts": m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$").cast("int"),
        "hint": before.rlike(rf"(?i)({GENERATORS[generator].hints})[^\n]{{0,12}}$").cast("int"),
        "before": _side(F.when(c["start"] > 0, F.substring(text, c["start"].cast("int"), F.lit(1)))),
        "after": _side(F.substring(text, (c["end"] + 1).cast("int"), F.lit(1))),
    }
    return F.array(*[named[name].cast("int") for name in FEATURES])


def candidates(text: Column) -> Column:
    """All generators' spans as structs of generator, start, end, x (the features)."""

    def of(k: int, g: Generator) -> Column:
        spans = _gated(text.rlike(g.gate), matches(text, g.pattern))
        return F.transform(
            spans,
            lambda c: F.struct(
                F.lit(k).alias("g"), c["start"], c["end"], _features(k, c, text).alias("x")
            ),
        )

    return F.concat(*[of(k, g) for k, g in enumerate(GENERATORS)])


@dataclass(frozen=True)
class Model:
    trees: list
    # Least log-odds per generator; None adds nothing.
    thresholds: tuple[float | None, ...]


def _annotated(docs: DataFrame) -> DataFrame:
    t = F.col("t")
    return (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
        .withColumns({f"_{kind}": spans for kind, spans in base_spans(t).items()})
        .withColumn("_candidates", candidates(t))
    )


def _evidence(c: Column) -> Column:
    """Whether a candidate beside the base spans is taken as right in learning."""

    def x(name: str) -> Column:
        return F.get(c["x"], F.lit(FEATURES.index(name)))

    card = (x("luhn") == 1) & x("first").between(3, 6) & x("digits").between(13, 19)
    dotted = (x("dots") == x("groups") - 1) & (x("dots") > 1) & (x("spaces") + x("dashes") == 0)
    right = {
        "email": x("spelled") == 1,
        "ip": F.lit(False),
        "card": card & (dotted | (x("hint") == 1)),
        "phone": (x("hint") == 1) & x("digits").between(7, 15) & (x("parts") == 0) & (x("groups") > 1),
    }
    cases = [F.when(c["g"] == k, right[g.kind]) for k, g in enumerate(GENERATORS)]
    return F.coalesce(*cases)


def _sampled(labelled: DataFrame, rows: int) -> list:
    """The ``rows`` of the smallest hash; a cut of the hashes bounds what tasks send."""
    labelled = materialise(labelled.sparkSession, labelled, "candidates")
    total = labelled.count()
    if total > 2 * rows:
        # Hashes are even over 64 bits: about twice the rows stay.
        limit = int(-(2**63) + 2**64 * (2 * rows / total))
        labelled = labelled.where(F.col("h") < F.lit(limit))
    return labelled.orderBy("h", "x", "y").limit(rows).collect()


def learn(docs: DataFrame, rows: int | None = None) -> Model:
    """Fit the trees and set the thresholds on all candidates, or on a sample of ``rows``."""
    each = _annotated(docs).where(F.size("_candidates") > 0)
    is_base, overlaps = F.lit(False), F.lit(False)
    for kind in KINDS:
        overlaps = overlaps | F.exists(
            f"_{kind}", lambda b: (b["start"] < F.col("c.end")) & (F.col("c.start") < b["end"])
        )
    for k, g in enumerate(GENERATORS):
        own = F.exists(
            f"_{g.kind}", lambda b: (b["start"] == F.col("c.start")) & (b["end"] == F.col("c.end"))
        )
        is_base = is_base | ((F.col("c.g") == k) & own)
    labelled = each.select(
        "doc_id", F.explode("_candidates").alias("c"), *[f"_{kind}" for kind in KINDS]
    )
    right = is_base | _evidence(F.col("c"))
    labelled = labelled.where(is_base | ~overlaps).select(
        F.xxhash64("doc_id", "c.start", "c.g").alias("h"), "c.x", right.cast("int").alias("y")
    )
    if rows is not None:
        labelled = docs.sparkSession.createDataFrame(_sampled(labelled, rows), labelled.schema)
    half = F.pmod(F.col("h"), F.lit(2)).alias("half")
    counted = labelled.groupBy(half, "x", "y").agg(F.count(F.lit(1)).alias("n")).collect()
    groups = sorted((r["half"], r["x"], r["y"], r["n"]) for r in counted)
    fitting = np.array([g[0] == 0 for g in groups], dtype=bool)
    x = np.array([g[1] for g in groups], dtype=np.int64).reshape(-1, len(FEATURES))
    y = np.array([g[2] for g in groups], dtype=float)
    n = np.array([g[3] for g in groups], dtype=float)
    trees = boosted_trees.fit(x[fitting], y[fitting], weight=n[fitting])
    x, y, n = x[~fitting], y[~fitting], n[~fitting]
    odds = boosted_trees.log_odds(trees, x)
    own = [x[:, 0] == k for k in range(len(GENERATORS))]
    return Model(trees, tuple(_threshold(odds[of], y[of], n[of]) for of in own))


def _threshold(odds: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> float | None:
    weight = np.ones(y.size) if weight is None else weight
    order = np.argsort(-odds, kind="stable")
    odds, right, seen = odds[order], np.cumsum((y * weight)[order]), np.cumsum(weight[order])
    last = np.append(odds[1:] != odds[:-1], True) if y.size else np.zeros(0, dtype=bool)
    good = np.flatnonzero(last & (right >= PRECISION * seen) & (seen >= LEAST_SEEN))
    return float(odds[good[-1]]) if good.size else None


def find(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, spans): structs of start, place of the kind, kind, end, base; by start."""
    fixed = F.concat(
        *[
            F.transform(f"_{kind}", _as_span(kind, k, True)) for k, kind in enumerate(KINDS)
        ]
    )
    known = _annotated(docs).withColumn("_base", F.array_sort(fixed))
    known = known.select("doc_id", "_base", _added(model).alias("_added"))
    return known.select("doc_id", F.array_sort(F.concat("_base", "_added")).alias("spans"))


def _as_span(kind: str, place: int, base: bool) -> Callable[[Column], Column]:
    return lambda c: F.struct(
        c["start"].alias("start"),
        F.lit(place).alias("place"),
        F.lit(kind).alias("kind"),
        c["end"].alias("end"),
        F.lit(base).alias("base"),
    )


def _added(model: Model) -> Column:
    """Candidates above their threshold that touch no base span, leftmost first."""
    parts = []
    for k, g in enumerate(GENERATORS):
        least = model.thresholds[k]
        if least is None:
            continue
        score = lambda c: boosted_trees.expression(model.trees, lambda i: F.get(c["x"], F.lit(i)))
        own = F.filter("_candidates", _chosen(k, least, score))
        parts.append(F.transform(own, _as_span(g.kind, k, False)))
    nothing = F.array().cast(
        "array<struct<start:bigint,place:int,kind:string,end:bigint,base:boolean>>"
    )
    if not parts:
        return nothing
    free = F.filter(
        F.array_sort(F.concat(*parts)),
        lambda c: ~F.exists("_base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])),
    )

    def take(acc: Column, c: Column) -> Column:
        fits = F.when(F.size(acc) == 0, F.lit(True)).otherwise(
            F.element_at(acc, -1)["end"] <= c["start"]
        )
        return F.when(fits, F.concat(acc, F.array(c))).otherwise(acc)

    return F.aggregate(free, nothing, take)


def _chosen(k: int, least: float, score: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda c: (c["g"] == k) & (score(c) >= least)


def report(found: DataFrame) -> DataFrame:
    """Counts per kind and a digest of the base spans, and all spans as text."""

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str) -> Column:
        own = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(own).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in KINDS],
        F.sha2(joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
