"""Leaks that windows with many slots, other cases and pooled slots have hidden."""

from receptionmart.llm import templates

DENSE = "Tom gave Mary 5 apples and Bob 7 pears while Ann kept 3 plums."
SHORT = "Tom gave Mary 5 apples and Bob 7 pears."
NAMES = "Pavich went home. Ee element stayed there. La au was quiet. Enle came back late with old Petra."
LONG = "first we count 12 green boats near the harbour wall before noon and then the keeper slowly paints the door blue while children sing old songs until 12 lamps burn"
TWO = "we put 3 red stones next to the 5 white shells and then carry all of them slowly home."


def leaks(spark, texts, items):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = templates.find_leaks(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()
    return {(r["doc_id"], r["item_id"]): (r["n_words"], r["verbatim"]) for r in found}


def test_windows_full_of_slots(spark):
    other = DENSE.replace("5", "8").replace("Mary", "Lisa")
    got = leaks(spark, ["So. " + DENSE, SHORT, other, SHORT.replace("5", "6"), "5 6 7 8 9 10 11 12", "1 2 3 4 5 6 7 8"], [DENSE, SHORT, "5 6 7 8 9 10 11 12"])
    assert {k: v for k, v in got.items() if k[1] != 1} == {(0, 0): (14, True), (2, 0): (14, False), (4, 2): (8, True)}
    assert got[1, 1] == (9, True) and got[3, 1] == (9, False)


def test_case_and_punctuation(spark):
    bare = NAMES.replace(".", "")
    texts = [NAMES, NAMES.lower(), NAMES.upper(), bare, "note - " + NAMES, "see 12) " + SHORT.lower(), "and " + SHORT, SHORT.upper()]
    got = leaks(spark, texts, [NAMES, SHORT])
    assert got == {(i, 0): (18, True) for i in range(5)} | {(i, 1): (9, True) for i in range(5, 8)}


def test_changed_values_and_joined_values(spark):
    last = LONG.replace("until 12", "until 13")
    joined = TWO.replace("3 red", "4 red").replace("5 white", "4 white")
    both = LONG.replace("12 green", "14 green").replace("until 12", "until 13")
    got = leaks(spark, [last, joined, both], [LONG, TWO])
    n = len(LONG.split())
    assert got == {(0, 0): (n - 3, True), (1, 1): (len(TWO.split()), False), (2, 0): (n - 7, True)}


def test_rows_are_texts_of_their_own(spark):
    a, b = (TWO.replace("3 red", f"{n} red").replace("5 white", f"{n + 1} white") for n in (20, 30))
    n = len(TWO.split())
    rows = [(None, a), (None, b), (7, TWO), (7, b), (7, b)]
    assert leaks(spark, rows, [TWO]) == {(None, 0): (n, False), (7, 0): (n, True)}
    # Two halves of an item in two rows with one id are no copy.
    words = TWO.split()
    halves = [(i, " ".join(part)) for i in (None, 7) for part in (words[:9] + ["x"] * 9, ["x"] * 9 + words[9:])]
    assert leaks(spark, halves, [TWO]) == {}
