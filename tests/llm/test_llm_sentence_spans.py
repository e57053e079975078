from __future__ import annotations

import random

from tillgrain.llm import sentence_spans
from tillgrain.llm.sentence_spans import Sentences

SCHEMA = "doc_id bigint, text string"


def sentence(rng):
    return " ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(3, 14))).capitalize() + "."


def brute_force(rows):
    """text after removal, documents in the order of their ids"""
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = text.encode()
        found = Sentences(data)
        bounds = [*found.byte_starts.tolist(), len(data)]
        gone, own = set(), set()
        for b, e, one, two in zip(*(x.tolist() for x in found.runs()), strict=True):
            if (one, two) in seen or (one, two) in own:
                gone.update(range(b, e + 1))
            own.add((one, two))
        seen |= own
        kept = [data[bounds[k] : bounds[k + 1]] for k in range(len(found)) if k not in gone]
        out[i] = (data[: bounds[0]] + b"".join(kept)).decode(), len(gone)
    return out


def run(spark, rows, extra=()):
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", *extra).repartition(4)
    return sentence_spans.remove_repeats(docs)


def test_removal_matches_brute_force(spark):
    rng = random.Random(4)
    pool = [" ".join(sentence(rng) for _ in range(8)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [sentence(rng) for _ in range(rng.randrange(1, 12))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(pool))
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in run(spark, rows).collect()}
    assert got == brute_force(rows)
    assert sum(n for _, n in got.values()) > 50


def test_a_passage_of_over_fifty_words_goes_from_all_but_the_first(spark):
    rng = random.Random(5)
    # One sentence without any stop, put into the middle of other sentences.
    passage = " ".join(f"p{rng.randrange(9999)}" for _ in range(70))
    rows = [(i, f"{sentence(rng)[:-1]} {passage} {sentence(rng)} {sentence(rng)}") for i in (3, 9, 4)]
    got = {r["doc_id"]: r["text"] for r in run(spark, rows).collect()}
    assert passage in got[3]
    words = passage.split()
    for i in (4, 9):
        left = sum(w in got[i].split() for w in words)
        assert left <= 30


def test_any_passage_of_over_fifty_words_shares_a_run():
    rng = random.Random(7)
    for trial in range(1500):
        size = rng.randrange(51, 61)
        passage = [f"p{rng.randrange(900)}" for _ in range(size)]
        if trial % 5 == 0:
            passage = [w + "." if rng.random() < 0.1 else w for w in passage]
        breaks = (0, 1, 2, 3, 7)[trial % 5]
        body = "".join(w + ("\n" if breaks and k % breaks == 0 else " ") for k, w in enumerate(passage))
        found = []
        for _ in range(2):
            around = [" ".join(f"n{rng.random()}" for _ in range(rng.randrange(40))) for _ in range(2)]
            glue = rng.choice([" ", "\n", ". "])
            _, _, one, two = Sentences(f"{around[0]}{glue}{body}{glue}{around[1]}".encode()).runs()
            found.append(set(zip(one.tolist(), two.tolist(), strict=True)))
        assert found[0] & found[1], (trial, body)


def occurrences(texts, size):
    """Every run of ``size`` words, without case, with its least (document, place)."""
    least = {}
    for i, text in sorted(texts):
        words = text.lower().split()
        for k in range(len(words) - size + 1):
            least.setdefault(tuple(words[k : k + size]), (i, k))
    return least


def test_only_repeated_words_go_and_long_passages_do(spark):
    """Held against the texts alone, without the operator's sentences and hashes."""
    rng = random.Random(11)
    pool = [" ".join(f"p{rng.randrange(5000)}" for _ in range(rng.randrange(51, 130))) for _ in range(5)]
    pool += [" ".join(sentence(rng) for _ in range(14)) for _ in range(5)]
    short = [" ".join(sentence(rng).split()[:5]) for _ in range(4)]
    rows = []
    for i in range(80):
        parts = [sentence(rng) for _ in range(rng.randrange(1, 14))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(pool))
        parts.insert(rng.randrange(len(parts) + 1), rng.choice(short))
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    kept = {r["doc_id"]: r["text"].split() for r in run(spark, rows).collect()}
    least, runs_of_51 = occurrences(rows, sentence_spans.TAIL_WORDS), occurrences(rows, 51)
    removed = 0
    for i, text in rows:
        words = text.split()
        for first, size, limit in ((least, sentence_spans.TAIL_WORDS, 0), (runs_of_51, 51, 40)):
            again = [False] * len(words)
            for k in range(len(words) - size + 1):
                if first[tuple(w.lower() for w in words[k : k + size])] != (i, k):
                    again[k : k + size] = [True] * size
            if limit == 0:
                # Words in no repeated run all stay, in their order.
                left = iter(kept[i])
                assert all(w in left for w, gone in zip(words, again, strict=True) if not gone), i
            else:
                # Of each repeated stretch at most five windows of words stay.
                stretches = "".join(".#"[x] for x in again).replace(".", " ").split()
                assert len(words) - len(kept[i]) >= sum(len(x) - limit for x in stretches), i
        removed += len(words) - len(kept[i])
    assert removed > 1000


def test_texts_of_one_id_and_one_tag_lose_their_own_runs_only(spark):
    rng = random.Random(12)
    passage = " ".join(sentence(rng) for _ in range(8))
    texts = [f"{k} {passage}" if k % 2 else f"{k} is short. It stays." for k in range(3000)]
    tagged = spark.createDataFrame(enumerate(texts), SCHEMA).select("text", sentence_spans._tag())
    by_tag = {}
    for r in tagged.collect():
        by_tag.setdefault((r["tag"]), {})["is short" in r["text"]] = r["text"]
    pair = next(x for x in by_tag.values() if len(x) == 2)
    got = run(spark, [(1, passage), (2, pair[True]), (2, pair[False])]).where("doc_id = 2")
    left = {r["text"] for r in got.collect()}
    assert pair[True] in left and len(left) == 2
    assert all(len(t) < len(passage) / 2 for t in left)


def test_unrelated_documents_stay_as_they_are(spark):
    rng = random.Random(6)
    licence = "Licensed under the Example License, Version 2.0."
    rows = [(i, "\n".join([*(sentence(rng) for _ in range(9)), licence])) for i in range(20)]
    assert sorted((r["doc_id"], r["text"]) for r in run(spark, rows).collect()) == rows


def test_edge_rows_and_clashing_columns(spark):
    text = (
        "One two three four. Five six seven eight. Nine ten eleven twelve. More words here. "
        "Thirteen fourteen fifteen sixteen. Seventeen eighteen nineteen twenty."
    )
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "Short."), (5, text), (5, text), (None, text), (6, text),
        (7, f"{text}\n{text}"), (8, "long word " * 60_000),
    ]
    got = run(spark, rows, ["'x' as n_removed", "1 as h1", "2 as first_id", "3 as starts", "4 as tag"])
    assert got.columns == ["doc_id", "text", "h1", "first_id", "starts", "tag", "n_sentences", "n_removed"]
    by_id = {}
    for r in got.collect():
        by_id.setdefault(r["doc_id"], []).append(r)
    assert by_id[1][0]["text"] is None and by_id[2][0]["text"] == "" and by_id[3][0]["text"] == " \n"
    assert by_id[4][0]["text"] == "Short."
    assert [r["text"] for r in by_id[5]] == [text, text]
    assert by_id[None][0]["text"] == text
    assert by_id[6][0]["text"] == "" and by_id[6][0]["n_removed"] == by_id[6][0]["n_sentences"]
    # The last words of the first copy are joined with the first ones of the second.
    assert len(by_id[7][0]["text"]) < 40
    assert len(by_id[8][0]["text"]) < 10_000


def test_repeats_inside_one_document_keep_the_first(spark):
    text = (
        "One two three four. Five six seven eight. Nine ten eleven twelve. "
        "Thirteen fourteen fifteen sixteen. Seventeen eighteen nineteen twenty."
    )
    got = run(spark, [(1, f"{text}\n{text}\nThe end.")]).first()
    assert got["text"] == f"{text}\nThe end."


def test_empty_table(spark):
    assert run(spark, []).count() == 0
