"""Stages of the corpus pipeline on rows with null and repeated ids."""

from collections import Counter

import corpus_pipeline

LEAK = "the quick keeper paints seven small doors blue while children near the harbour sing old songs till noon"
TEXTS = {k: " ".join(f"{k}{i}" for i in range(40)) for k in "abcdefg"}


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def ids_and_texts(df):
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_near_copies_go_by_row(spark):
    near = TEXTS["a"] + " more"
    a, b, c, d, e = (TEXTS[k] for k in "abcde")
    rows = [(4, a), (3, near), (None, a), (9, a), (5, b), (5, b), (5, b), (None, c), (None, c), (9, d), (3, e)]
    blank = [(1, None), (1, ""), (2, " \n\t"), (None, None), (None, "")]
    out = corpus_pipeline.drop_near_copies(spark, frame(spark, rows + blank), "")
    assert out.columns == corpus_pipeline.COLUMNS
    assert ids_and_texts(out) == Counter([(3, near), (5, b), (None, c), (9, d), (3, e), *blank])
    assert corpus_pipeline.drop_near_copies(spark, frame(spark, rows).limit(0), "").collect() == []


def test_leaks_go_by_row(spark, tmp_path):
    spark.createDataFrame([(1, LEAK)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    leak = "Some words. " + LEAK + " and more"
    clean = [(1, TEXTS["a"]), (None, TEXTS["b"]), (None, None), (1, ""), (2, TEXTS["c"]), (2, TEXTS["c"])]
    out = corpus_pipeline.drop_leaks(spark, frame(spark, [(1, leak), (None, leak), (None, LEAK), (3, leak), (3, leak), *clean]), str(tmp_path))
    assert out.columns == corpus_pipeline.COLUMNS and ids_and_texts(out) == Counter(clean)
