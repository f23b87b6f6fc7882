"""Near-duplicate classes and links against all pairs."""

import random
from dataclasses import replace

import pytest

from receptionmart.llm import chosen_path
from receptionmart.llm.chosen_path import Join, near_duplicates


def all_pairs(texts, least=0.8, width=5):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        n = max(1, len(w) - width + 1)
        sets.append(frozenset(tuple(w[i : i + width]) for i in range(n)) if w else frozenset())
    root, links = list(range(len(texts))), [0] * len(texts)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or (a & b and len(a & b) >= least * len(a | b)):
                links[i] += 1
                links[j] += 1
                x, y = sorted((top(i), top(j)))
                root[y] = x
    return [top(i) for i in range(len(texts))], links


def corpus():
    r = random.Random(7)
    word = lambda: r.choice("abcdefghij") + r.choice("klmnop") + str(r.randrange(40))
    line = " ".join(word() for _ in range(14))
    texts = [None, "", "one two", "one two", "ONE  two", "x", "  \n "]
    for _ in range(60):
        base = [word() for _ in range(r.choice([6, 20, 60, 150]))]
        texts.append(" ".join(base))
        for _ in range(r.randrange(4)):
            copy = list(base)
            for _ in range(r.randrange(1, 4)):
                copy[r.randrange(len(copy))] = word()
            texts.append(" ".join(copy) + (" " + line if r.random() < 0.3 else ""))
    hot = [word() for _ in range(80)]
    for _ in range(70):
        copy = list(hot)
        copy[r.randrange(80)] = word()
        texts.append(" ".join(copy))
    texts += [" ".join(hot)] * 30 + [line + " " + " ".join(word() for _ in range(25)) for _ in range(60)]
    texts.append(" ".join(word() for _ in range(20000)))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("join", [Join(), replace(Join(), bucket=8, chunk=16, alike=2.0, runs=24), replace(Join(), bucket=8, chunk=16)])
def test_same_as_all_pairs(spark, join, monkeypatch):
    texts = corpus()
    want_class, want_links = all_pairs(texts)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, key string")
    got = {r["doc_id"]: r for r in near_duplicates(df, join).collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == want_class
    assert [got[i]["n_links"] for i in range(len(texts))] == want_links


def test_shuffled_ways_give_the_same(spark, monkeypatch):
    texts = corpus()[:150]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = sorted(near_duplicates(df, replace(Join(), bucket=8)).collect())
    monkeypatch.setattr(chosen_path, "small_enough", lambda df, rows: False)
    monkeypatch.setattr("receptionmart.llm.common.small_enough", lambda df, rows: False)
    assert sorted(near_duplicates(df, replace(Join(), bucket=8)).collect()) == want


def test_nulls_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, None), (9, "")], "doc_id long, text string")
    got = sorted((r["doc_id"] or -1, r["class_id"], r["n_links"]) for r in near_duplicates(df).collect())
    assert got == [(-1, 3, 2), (-1, 9, 1), (3, 3, 2), (3, 3, 2), (9, 9, 1)]
    assert near_duplicates(df.limit(0)).collect() == []
