"""Operators that read texts one by one, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from receptionmart.llm import licenses, linededup, packing, pii, repetition, templates, toxicity

R = random.Random(3)
WORDS = ["alpha", "beta", "Gamma,", "delta.", "été", "zu", "o'n", "x1"]
TEXTS = [None, "", " \n\t", "one", "a b c " * 30, " ".join(R.choice(WORDS) for _ in range(3000)), "Line one\n line ONE \nx\n\nx"] + [
    " ".join(R.choice(WORDS) + str(R.randrange(50)) for _ in range(R.randrange(1, 120))) for _ in range(40)
]


def frame(spark, texts, ids=None):
    """With columns whose names clash with those of results."""
    rows = [(i if ids is None else ids[i], t, 1, "k", True) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, start int, key string, kept boolean")


def repeats(words, width):
    seen = Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))
    inside = set()
    for i in range(len(words) - width + 1):
        if seen[tuple(words[i : i + width])] > 1:
            inside.update(range(i, i + width))
    return len(inside)


def test_repetition(spark):
    got = {r["doc_id"]: r for r in repetition.judge_repetition(frame(spark, TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, base, cover = len(words), repeats(words, 3), repeats(words, 10)
        failed = n < 50 or 100 * base > 50 * n
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_covered_words"], r["base_failed"]) == (n, sum(map(len, words)), base, cover, failed)
        assert r["kept"] == (not failed and 100 * cover <= 30 * n and not repeats(words, 101))
        assert r["longest_repeat"] == max([w for w in range(1, n + 1) if repeats(words, w)], default=0) if n < 200 else True
    assert repetition.judge_repetition(frame(spark, TEXTS).limit(0)).collect() == []


def test_line_dedup_both_ways(spark):
    common = ["Shared line", "  shared LINE\t", "other é", "#"]
    texts = [None, "", "\n\n"] + ["\n".join(R.sample(common, 2) + [str(R.random())]) for _ in range(60)] + ["#\n#"] * 3
    want = {}
    keys = [[line.encode().strip().lower() for line in (t or "").split("\n")] for t in texts]
    docs = Counter(k for own in keys for k in set(own) if k)
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        stay = [line for line, k in zip(lines, keys[i]) if docs[k] < 10]
        want[i] = ("\n".join(stay), len(lines), len(lines) - len(stay))
    # Tiny filters only make more suspects; without a broadcast the lines are joined.
    for rule in (linededup.Rule(), linededup.Rule(filter_bits=1 << 13), linededup.Rule(broadcast_bytes=-1)):
        out = linededup.drop_lines(frame(spark, texts), rule)
        assert out.columns == ["doc_id", "text", "start", "key", "kept", "n_lines", "n_dropped"]
        assert {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()} == want
    assert linededup.drop_lines(frame(spark, texts).limit(0)).collect() == []


def test_line_dedup_keeps_the_first(spark):
    texts = ["b", "a\nb\na", "a", "c"]
    out = linededup.drop_lines(frame(spark, texts), linededup.Rule(min_docs=2, keep_first=True))
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {0: "b", 1: "a", 2: "", 3: "c"}


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 40, 4, 500)])
def test_packing_is_a_round_trip(spark, limits):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    file = path("word_bpe_49k.json")
    texts = [*TEXTS, "Don't <|endoftext|> x", "ΑΣ ı İ 日本 é", "a\x1cb​c", "x " * 9000]
    df = frame(spark, texts).selectExpr("*", "doc_id % 2 = 0 AS bears")
    rows = packing.pack_texts(df, file, limits=limits, loss_col="bears").collect()
    plain = Tokenizer.from_file(file)
    ids = {i: plain.encode(t or "", add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}
    places, sequences = {i: 0 for i in ids}, {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["start"])):
        own = ids[r["doc_id"]]
        assert r["start"] == places[r["doc_id"]] and r["doc_tokens"] == len(own) and r["length"] > 0
        places[r["doc_id"]] += r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(own[r["start"] : r["start"] + r["length"]], "<u4").tobytes())
        sequences.setdefault(r["sequence_id"], []).append(r)
    assert places == {i: len(x) for i, x in ids.items()}
    padding = 0
    for own in sequences.values():
        own.sort(key=lambda r: r["offset"])
        total = sum(r["length"] for r in own)
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        assert total <= limits.tokens and len(own) <= limits.segments
        assert sum(r["length"] for r in own if r["doc_id"] % 2 == 0) <= limits.loss_tokens
        padding += limits.tokens - total if total & (total - 1) else 0
    assert padding <= 0.02 * sum(places.values())
    assert packing.pack_texts(df.limit(0), file, loss_col="bears").collect() == []


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(int(d) if i % 2 == 0 else int(d) * 2 - 9 * (int(d) > 4) for i, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_base_spans(spark):
    texts = [
        None, "", "é a.b@c.d_e@f.g.h-i x@y @z.a", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.004 1.2.3", "4111 1111 1111 1111, 4111-1111-1111-1112 9 99",
        "+1 (415) 555-0100 +12 ++49 30 1234567. 415-555-0100", "9" * 5000 + " " + "a" * 20000 + "@", "x@y.z" * 50,
    ]
    signs = "19.+-@ a(é"
    texts += ["".join(R.choice(signs) for _ in range(60)) for _ in range(300)]
    got = {r["doc_id"]: r for r in pii.find_spans(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, t or "") if passes(k, m[0])]
        assert [(s["kind"], s["start"], s["end"]) for s in got[i]["base"]] == want
        assert all(b["end"] <= s["start"] or s["end"] <= b["start"] for s in got[i]["added"] for b in got[i]["base"])
    assert pii.find_spans(frame(spark, texts).limit(0)).collect() == []


def test_weak_labels_find_what_patterns_miss(spark):
    texts = ["call me at 415-555-%04d or mail" % i for i in range(40)] + ["phone +1 415 555 %04d now" % i for i in range(40)] + ["order 415-555-%04d7 id" % i for i in range(40)]
    got = {r["doc_id"]: r["added"] for r in pii.find_spans(frame(spark, texts), pii.Settings(threshold=0.6)).collect()}
    assert sum(bool(got[i]) for i in range(40)) >= 36 and not any(got[i] for i in range(80, 120))


def test_expectation_maximisation_recovers_reliability():
    r = random.Random(5)
    votes = Counter()
    for _ in range(5000):
        truth = r.random() < 0.4
        votes[tuple(int(truth) if r.random() < p else int(not truth) for p in (0.95, 0.9, 0.85, 0.55))] += 1
    odds = pii.estimate(sorted(votes.items()), pii.Settings())
    assert odds[1, 1, 1, 0] > 0.95 and odds[0, 0, 0, 1] < 0.05 and odds[1, 0, 0, 1] < odds[1, 1, 0, 0]


def test_license_rules(spark):
    texts = [
        None, "Released under the MIT License. Licensed under the Apache License, Version 2.0\nmore",
        "Licensed under the Apache License, Version 2.0; X y. You may not use this file except in compliance with the License. You may obtain a copy of the License at\n"
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS.",
    ]
    got = sorted(tuple(r)[:5] for r in licenses.find_licenses(frame(spark, texts)).collect())
    assert got == [(1, "Apache-2.0", 1, 1, 1), (1, "MIT", 1, 0, 0), (2, "Apache-2.0", 4, 0, 4)]
    assert licenses.find_licenses(frame(spark, texts).limit(0)).collect() == []


def test_leaks_with_other_slots(spark):
    item = "A train leaves London with 12 passengers and picks up 30 km later 12 more people before it stops again."
    plain = "colourless green ideas sleep furiously while nobody in the whole village looks on at all today."
    same = "Some words. " + item.replace("12", "17").replace("30", "8").replace("London", "Madrid") + " More words here."
    mixed = item.replace("12 passengers", "5 passengers").replace("12 more", "6 more")
    texts = [None, "", item, same, mixed, "short", "nothing of it here " * 5000, "x. " + plain, " ".join(plain.split()[:9])]
    items = spark.createDataFrame([(1, item), (2, plain), (3, None), (4, "tiny one")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["verbatim"] for r in templates.find_leaks(frame(spark, texts), items).collect()}
    assert got == {(2, 1): True, (3, 1): False, (7, 2): True}
    assert templates.find_leaks(frame(spark, texts).limit(0), items).collect() == []
    assert templates.find_leaks(frame(spark, texts), items.limit(0)).collect() == []


def test_toxicity_learns_and_ties_are_stable(spark):
    r = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    texts, labels = [None, ""], [0, 0]
    for i in range(600):
        own, bad = [r.choice(words) for _ in range(r.randrange(20, 60))], i % 5 == 0
        for _ in range(4 * bad):
            own[r.randrange(len(own))] = r.choice(["vile", "nasty", "rotten"])
        texts.append(" ".join(own))
        labels.append(int(bad))
    df = frame(spark, texts)
    marks = spark.createDataFrame([(i, y) for i, y in enumerate(labels) if i % 3] + [(None, 1), (5, None), (7, 9)], "doc_id long, label int")
    small = replace(toxicity.Learner(), bits=18)
    got = {x["doc_id"]: x for x in toxicity.score_toxicity(df, marks, df, small).collect()}
    assert len(got) == len(texts) and all(0 <= x["score"] <= 1 for x in got.values())
    wrong = sum(got[i]["predicted"] != y for i, y in enumerate(labels) if i % 3 == 0)
    assert wrong <= 0.05 * len(labels) / 3
    assert {x["score"] for x in toxicity.score_toxicity(df, marks.limit(0), df, small).collect()} == {0.5}
    assert toxicity.score_toxicity(df.limit(0), marks, df, small).collect() == []


def test_joined_lines_with_clashing_names(spark):
    """Columns named like those of the joined way stay as they are; the smallest id keeps a repeated line, null first."""
    data = [(i, f"same\n{i}", i, i, i) for i in range(3)] + [(None, "same", 9, 9, 9)]
    df = spark.createDataFrame(data, "doc_id long, text string, row int, _row int, _Drops int")
    rule = linededup.Rule(min_docs=2, keep_first=True, filter_bits=1 << 16)
    got = linededup.drop_lines(df, rule).collect()
    assert {(r["doc_id"], r["text"], r["row"], r["_row"], r["_Drops"]) for r in got} == {(None, "same", 9, 9, 9)} | {(i, f"{i}", i, i, i) for i in range(3)}
