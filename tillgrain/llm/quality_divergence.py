"""Quality rules by distribution divergence, in DataFrame functions only.

Two histograms of each document are compared with those of every language by the
Jensen-Shannon distance: classes of characters, and the language's common words with one
cell for all other words. The languages' histograms are sums over all documents with a
non-null ``lang``; common words are the most frequent words of up to ``WORD_LETTERS``
characters, as written. A document fails when even its nearest language is farther than the limit. Short documents
scatter by chance, so a histogram is only judged from its minimum length on, and
between that and ``SETTLED`` times it the limit is wider.

References have a few dozen numbers per language; they are collected and stand in the
plan as literals. Documents are never shuffled; only counts per language are.

Defined cases: a null text is an empty one: no words, base_failed. Without labelled
documents only the base rules decide. Repeated rows and rows without an id are judged
like any other; columns besides doc_id, text and lang are ignored.
"""

from __future__ import annotations


from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillgrain.llm.support import materialise

BLANKS = r"\x20\x09-\x0D"
SYMBOLS = r"#*$%&|<>"
# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COMMON_WORDS = 30
WORD_LETTERS = 6
# Limits on the distance (0 to 1), and the least characters or words it is judged from.
CHARACTER_LIMIT = 0.25
CHARACTER_LENGTH = 250
WORD_LIMIT = 0.3
WORD_LENGTH = 50
SETTLED = 4

# Classes of characters; all others, letters for the most part, are the last class.
CLASSES = {
    "upper": r"\p{Lu}",
    "accented": r"[^\x00-\x7F&&[^\p{Lu}]]",
    "digit": r"[0-9]",
    "stop": r"[.,;:?!'\"()-]",
    "symbol": rf"[{SYMBOLS}]",
}


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also where a filter is pushed down."""
    return F.transform(F.array(value), use)[0]


def _with_words(docs: DataFrame) -> DataFrame:
    """doc_id, lang, t, its pieces between single blanks, and the words: those not empty."""
    text = F.coalesce("text", F.lit(""))
    pieces = docs.select("doc_id", "lang", text.alias("t")).withColumn(
        "_pieces", F.split("t", f"[{BLANKS}]")
    )
    return pieces.withColumn("words", F.array_remove("_pieces", ""))


# Characters of no class that most of a text consists of: taken out in runs before counting.
FREQUENT = r"[a-z \n]+"


def _class_counts(text: Column) -> Column:
    """Characters per class, and the total."""

    def of_classes(rest: Column) -> Column:
        others = [F.length(F.regexp_replace(rest, f"{c}+", "")) for c in CLASSES.values()]
        return _let(
            F.length(rest), lambda n: F.array(*[(n - x).cast("bigint") for x in others])
        )

    counts = _let(F.regexp_replace(text, FREQUENT, ""), of_classes)
    return F.concat(counts, F.array(F.length(text).cast("bigint")))


def _split_rest(counts: Column) -> Column:
    """Replace the total in the last place by what the classes leave."""
    k = len(CLASSES)
    rest = F.get(counts, F.lit(k)) - _total(F.slice(counts, 1, k))
    return F.concat(F.slice(counts, 1, k), F.array(rest))


# -- base rules --------------------------------------------------------------------


def repeated_words(windows: Column) -> Column:
    """Words inside 3-word windows (as hashes, by position) that occur twice or more."""

    def covered(once: Column) -> Column:
        # Windows that occur once keep their order, so the next of them is always entry ``k``;
        # ``left`` are the words from here on that an earlier window has counted.
        def step(seen: Column, window: Column) -> Column:
            k, left, n = seen["k"], seen["left"], seen["n"]
            return F.when(
                window.eqNullSafe(F.get(once, k)), state(k + 1, F.greatest(left - 1, F.lit(0)), n)
            ).otherwise(state(k, F.lit(2), n + 3 - left))

        return F.aggregate(
            windows, state(F.lit(0), F.lit(0), F.lit(0)), step, lambda seen: seen["n"]
        )

    def state(k: Column, left: Column, n: Column) -> Column:
        return F.struct(k.alias("k"), left.alias("left"), n.alias("n"))

    twice = _let(
        F.sort_array(windows), lambda s: F.filter(s, lambda h, k: h == F.get(s, k + 1))
    )
    repeats = F.size(windows) > F.size(F.array_distinct(windows))
    within = _let(F.array_except(windows, twice), covered)
    return F.when(repeats, within).otherwise(F.lit(0)).cast("bigint")


def base_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the words, class counts and the base measures."""
    windows = _let(
        F.transform("words", lambda w: F.xxhash64(w)),
        lambda h: F.transform(
            F.slice(h, F.lit(1), F.greatest(F.size(h) - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)),
        ),
    )
    lines = F.filter(F.split("t", "\n"), lambda line: line.rlike(f"[^{BLANKS}]"))
    measured = (
        _with_words(docs)
        .withColumn("_w", windows)
        .withColumn("_l", lines)
        .withColumn("_c", _class_counts(F.col("t")))
    )
    symbols = F.get("_c", F.lit(list(CLASSES).index("symbol")))
    length = F.get("_c", F.lit(len(CLASSES)))
    blanks = F.size("_pieces") - 1
    return measured.select(
        "doc_id",
        "words",
        "_c",
        F.size("words").cast("bigint").alias("n_words"),
        (length - blanks).alias("word_chars"),
        symbols.alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        repeated_words(F.col("_w")).alias("n_repeat_words"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    )


# -- references ---------------------------------------------------------------------


def _shares(counts: list[int]) -> list[float]:
    total = sum(counts)
    return [c / total if total else 0.0 for c in counts]


def references(docs: DataFrame) -> dict[str, tuple[list[float], list[str], list[float]]]:
    """Per language: shares of character classes; common words; their shares, others last."""
    labelled = docs.where("lang is not null and text is not null")
    counted = labelled.select("lang", _class_counts(F.col("text")).alias("c"), "text")
    sums = [F.sum(F.get("c", F.lit(k))).alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    classes = counted.groupBy("lang").agg(*sums).collect()
    each = _with_words(labelled).select("lang", F.explode("words").alias("w"))
    # All longer words meet in one cell per language before they are shuffled. The counts
    # are stored, as both the common words and the totals come from them.
    words = materialise(
        docs.sparkSession,
        each.groupBy("lang", F.when(F.length("w") <= WORD_LETTERS, F.col("w")).alias("w")).agg(
            F.count(F.lit(1)).alias("n")
        ),
        "words",
    )
    top = Window.partitionBy("lang").orderBy(F.col("n").desc(), "w")
    common = (
        words.where("w is not null")
        .withColumn("place", F.row_number().over(top))
        .where(F.col("place") <= COMMON_WORDS)
        .collect()
    )
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    out = {}
    for row in sorted(classes, key=lambda r: r["lang"]):
        c = [row[f"c{k}"] for k in range(len(CLASSES) + 1)]
        c[-1] -= sum(c[:-1])
        own = sorted((r["place"], r["w"], r["n"]) for r in common if r["lang"] == row["lang"])
        n = [x[2] for x in own]
        rest = totals.get(row["lang"], 0) - sum(n)
        out[row["lang"]] = (_shares(c), [x[1] for x in own], _shares([*n, rest]))
    return out


# -- distances ----------------------------------------------------------------------


def jensen_shannon(counts: Column, sum_of_counts: Column, reference: Column) -> Column:
    """Distance (base 2) of a histogram of counts from shares; 1 where it is empty.

    The sum is a column of its own: inside the lambda it would be added up per cell.
    """
    total = F.greatest(sum_of_counts, F.lit(1)).cast("double")

    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))

    def cell(c: Column, q: Column) -> Column:
        p = c / total
        m = (p + q) / 2
        return (part(p, m) + part(q, m)) / 2

    cells = F.zip_with(counts, reference, cell)
    sum_ = F.aggregate(cells, F.lit(0.0), lambda a, x: a + x)
    return F.when(sum_of_counts > 0, F.sqrt(F.greatest(sum_, F.lit(0.0)))).otherwise(F.lit(1.0))


def counts_of(words: Column, sought: list[str]) -> Column:
    """How often each of ``sought`` (sorted, distinct) occurs in the words.

    The words found are sorted together with one more of each sought: a run of equal
    words for each, in their order, one longer than the word is frequent.
    """
    if not sought:
        return F.array().cast("array<bigint>")
    found = F.filter(words, lambda w: w.isin(sought))
    ordered = F.sort_array(F.concat(found, F.array(*map(F.lit, sought))))
    ends = _let(
        ordered,
        lambda s: F.array_compact(
            F.transform(s, lambda w, i: F.when(~w.eqNullSafe(F.get(s, i + 1)), i.cast("bigint")))
        ),
    )
    return _let(
        ends,
        lambda e: F.transform(
            e, lambda end, k: end - F.coalesce(F.get(e, k - 1), F.lit(-1).cast("bigint")) - 1
        ),
    )


def _limit(base: float, length: Column, least: int) -> Column:
    """The limit of a settled length, up to half as wide again at the least length."""
    spare = F.greatest(F.lit(0.0), 1 - (length - least) / F.lit(float(least * (SETTLED - 1))))
    return F.lit(base) * (1 + spare / 2)


def judge(docs: DataFrame) -> DataFrame:
    """Per row: the base measures, base_failed, kept, and both distances."""
    based = base_rules(docs)
    known = references(docs)
    shown = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    if not known:
        none = F.lit(None).cast("double")
        return based.select(
            "doc_id",
            *shown,
            (~F.col("base_failed")).alias("kept"),
            none.alias("js_characters"),
            none.alias("js_words"),
        )
    every = sorted({w for _, words, _ in known.values() for w in words})
    place = {w: k for k, w in enumerate(every)}
    counted = based.select(
        "doc_id",
        *shown,
        _split_rest(F.col("_c")).alias("_c"),
        F.get("_c", F.lit(len(CLASSES))).alias("_length"),
        counts_of(F.col("words"), every).alias("_common"),
    )

    # One array of references, folded to a literal: the plan does not grow with languages.
    languages = F.array(
        *[
            F.struct(
                F.array(*[F.lit(x) for x in classes]).alias("characters"),
                F.array(*[F.lit(place[w]) for w in words]).cast("array<int>").alias("places"),
                F.array(*[F.lit(x) for x in shares]).alias("shares"),
            )
            for classes, words, shares in known.values()
        ]
    )

    def word_counts(d: Column, places: Column) -> Column:
        found = F.transform(places, lambda k: F.get(d["common"], k))
        return _let(found, lambda c: F.concat(c, F.array(d["n"] - _total(c))))

    by_language = _let(
        F.struct(
            F.col("_c").alias("c"),
            F.col("_common").alias("common"),
            F.col("_length").alias("length"),
            F.col("n_words").alias("n"),
        ),
        lambda d: F.transform(
            languages,
            lambda r: F.struct(
                jensen_shannon(d["c"], d["length"], r["characters"]).alias("characters"),
                jensen_shannon(word_counts(d, r["places"]), d["n"], r["shares"]).alias("words"),
            ),
        ),
    )
    total = F.col("_length")
    characters = F.col("_near.characters") / _limit(CHARACTER_LIMIT, total, CHARACTER_LENGTH)
    words = F.col("_near.words") / _limit(WORD_LIMIT, F.col("n_words"), WORD_LENGTH)
    far = ((total >= CHARACTER_LENGTH) & (characters > 1)) | (
        (F.col("n_words") >= WORD_LENGTH) & (words > 1)
    )
    nearest = F.array_min(
        F.transform(
            "_js",
            lambda d: F.struct(
                F.greatest(d["characters"] / CHARACTER_LIMIT, d["words"] / WORD_LIMIT).alias("d"),
                d["characters"].alias("characters"),
                d["words"].alias("words"),
            ),
        )
    )
    return (
        counted.withColumn("_js", by_language)
        .withColumn("_near", nearest)
        .select(
            "doc_id",
            *shown,
            (~F.col("base_failed") & ~far).alias("kept"),
            F.col("_near.characters").alias("js_characters"),
            F.col("_near.words").alias("js_words"),
        )
    )


