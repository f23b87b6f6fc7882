"""Places and contexts of spans against plain Python."""

import random

import pytest
import regex
from pyspark.sql import functions as F

from receptionmart.llm import pii

BITS = [
    "a@b.c", "x.y@host.org ", "mail to ", "+1 (212) 555-0100", "10.0.0.1", "999.1.1.1", "4111 1111 1111 1111", "é", "中文 ", " ",
    "212-555-0123", "\n", ", ", "1 2", "12", "-", "@", "+", "version ", "A" * 60,
]


def plain(text, pattern):
    return [
        (m.start(), m.end(), m.group(), text[max(0, m.start() - pii.CONTEXT_CHARS) : m.start()], text[m.end() : m.end() + 1])
        for m in regex.finditer(pattern, text)
    ]


@pytest.mark.parametrize("kind", pii.KINDS)
def test_places_and_contexts(spark, kind):
    draw = random.Random(kind)
    texts = [""] + ["".join(draw.choices(BITS, k=n)) for n in [1, 2, 3, 8, 30] * 10 + [300, 3000]]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found = df.select("id", pii.found_spans(F.col("text"), pii.BASE[kind], pii.NEEDS.get(kind)).alias("s")).collect()
    assert {r["id"]: [tuple(s) for s in r["s"]] for r in found} == {i: plain(t, pii.BASE[kind]) for i, t in enumerate(texts)}
    assert max(len(r["s"]) for r in found) > 3 * pii.BLOCK_PIECES


def test_many_matches_in_one_text(spark):
    n = 32_000
    df = spark.createDataFrame([(1, "".join(f"u{i}@h{i}.com " for i in range(n)))], "doc_id long, text string")
    spans = pii.scan(df, "doc_id", "text").select(F.filter("cands", lambda c: c["ok"]).alias("s")).first()["s"]
    places, at = [], 0
    for i in range(n):
        size = len(f"u{i}@h{i}.com")
        places.append((at, at + size))
        at += size + 1
    assert [(s["start"], s["end"]) for s in spans] == places
