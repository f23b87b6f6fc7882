"""Hosts, hard negatives and phrases against plain Python."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from receptionmart.llm import collocations, hard_negatives, queries, reputation
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


# --- hosts ---------------------------------------------------------------------------------------------


def fit(url, rules):
    found = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host = found[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) if found else ""
    path = found[2] if found else ""
    best = None
    for verdict, rule in rules:
        rule_host, slash, rest = rule.partition("/")
        if host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rest):
            best = max(best or (0,), (len(rule), len(rule_host), verdict, rule))
    return host, path, best and best[3], best and best[2]


def test_rules_fit_by_host_ending_and_path(spark):
    rules = [*queries.URL_RULES, ("block", "x.org"), ("allow", "b.net/xy"), ("block", "a.b.net/x"), ("block", "b.net/xy")]
    urls = [
        "http://EXAMPLE.org/es/1", "http://m.example.org/en/1234?x", "http://example.org/en/2#/es/", "https://notexample.org/es/", "http://x.org",
        "http://y.x.org?q=/", "//no.org/a", "http://a.b.net/xyz", "http://q.com/de/://a.org/", "http://q.com/fr/\nnew", "", None, "http://", "http:///p",
        "http://Ünï.com/de/", "http://org/", "http://u:p@example.org:80/es/", "http://a..org/b", "x://y://z.org/",
    ]
    data = [(i if i != 4 else None, u, "block", "row") for i, u in enumerate(urls)] + [(0, urls[0], "x", "y")] * 2
    pages = spark.createDataFrame(data, "page_id long, url string, rule string, row string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = reputation.judge_urls(pages, none, reputation.rules_frame(spark, rules)).collect()
    want = Counter((d[0], *fit(d[1], rules)[:3], fit(d[1], rules)[3] or "allow") for d in data)
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == want
    assert reputation.judge_urls(pages.limit(0), none, reputation.rules_frame(spark, rules)).collect() == []
    assert {r["rule"] for r in reputation.judge_urls(pages, none, reputation.rules_frame(spark, [])).collect()} == {None}


def plain_rates(outcomes, rule):
    """Posterior rate and size by site, from (site, domain, suffix, bad) rows; bad None: no outcome."""
    total = [b for *_, b in outcomes if b is not None]
    every = (sum(total) + 1) / (len(total) + 2)

    def level(names, parent):
        counts = defaultdict(lambda: [0, 0])
        for row in outcomes:
            own = counts[names(row)]
            own[0] += row[3] is not None
            own[1] += bool(row[3])
        beyond = room = 0.0
        for name, (n, k) in counts.items():
            m = parent(name)
            beyond += (k - n * m) ** 2 - n * m * (1 - m)
            room += n * (n - 1) * m * (1 - m)
        r = min(max(beyond / room if room else rule.most_spread, rule.least_spread), rule.most_spread)
        prior = 1 / r - 1
        return {name: ((parent(name) * prior + k) / (prior + n), prior + n) for name, (n, k) in counts.items()}

    tops = level(lambda r: r[2], lambda _: every)
    domains = level(lambda r: (r[1], r[2]), lambda name: tops[name[1]][0])
    return level(lambda r: r[:3], lambda name: domains[name[1:]][0]), every


def test_hosts_are_shrunk_level_by_level(spark):
    r = random.Random(3)
    names = [("good.a.co.uk", "a.co.uk", "co.uk"), ("bad.a.co.uk", "a.co.uk", "co.uk"), ("b.com", "b.com", "com"), ("w.b.com", "b.com", "com"), ("10.0.0.1", "10.0.0.1", "10.0.0.1")]
    rates = {"good.a.co.uk": 0.05, "bad.a.co.uk": 0.9, "b.com": 0.1, "w.b.com": 0.2, "10.0.0.1": 0.1}
    rows = [(*n, r.random() < rates[n[0]]) for n in names for _ in range(60)]
    rows += [("seldom.bad.com", "bad.com", "com", True), ("new.b.com", "b.com", "com", None), ("x.new", "x.new", "new", None)]
    pages = spark.createDataFrame([(i, f"http://u@{s[0].upper()}.:8080/p{i}") for i, s in enumerate(rows)], "page_id long, url string")
    outcomes = spark.createDataFrame([(i, s[3]) for i, s in enumerate(rows)] + [(None, True), (10**6, True)], "page_id long, bad boolean")
    got = reputation.judge_urls(pages, outcomes, reputation.rules_frame(spark, [("allow", "z.zz/")])).collect()
    rule = reputation.Rule()
    want, _ = plain_rates(rows, rule)
    for row in got:
        rate, size = want[rows[row["page_id"]][:3]]
        assert row["rate"] == pytest.approx(rate) and row["lower"] == pytest.approx(rate - rule.deviations * math.sqrt(rate * (1 - rate) / (size + 1)))
        assert row["verdict"] == ("block" if row["lower"] > rule.most_bad else "allow")
    verdicts = {rows[row["page_id"]][0]: row["verdict"] for row in got}
    assert verdicts["bad.a.co.uk"] == "block" and verdicts["good.a.co.uk"] == verdicts["new.b.com"] == verdicts["seldom.bad.com"] == "allow"


# --- hard negatives ------------------------------------------------------------------------------------


def plain_negatives(rows, rule=hard_negatives.Rule()):
    """``rows`` of (vec_id, vector, label, is anchor) with usable vectors."""
    width = max((len(v) for _, v, _, _ in rows), default=0)
    x = np.zeros((len(rows), width), object)
    for i, (_, v, _, _) in enumerate(rows):
        x[i, : len(v)] = [math.floor(rule.scale * float(c)) for c in v]
    order = lambda scores: lambda i: (-scores[i], rows[i][0] is None, rows[i][0] or 0, i)
    out = []
    for a, (anchor, _, label, is_anchor) in enumerate(rows):
        if not is_anchor:
            continue
        scores = [int(s) for s in x @ x[a]]
        ranked = sorted((i for i in range(len(rows)) if i != a), key=order(scores))
        for p in [i for i in ranked if rows[i][2] == label][: rule.positives]:
            fits = [i for i in ranked if rows[i][2] != label and rule.low_percent * scores[p] <= 100 * scores[i] <= rule.high_percent * scores[p]]
            out += [(anchor, rows[p][0], k + 1, rows[i][0], scores[p], scores[i]) for k, i in enumerate(fits[: rule.negatives])]
    return out


@pytest.mark.parametrize("rule", [hard_negatives.Rule(row_block=37, anchor_block=5, dimensions=3), hard_negatives.Rule(scale=1 << 20, negatives=9, steps=1)])
def test_negatives_equal_all_products(spark, rule):
    r = random.Random(4)
    centre = [[r.gauss(0, 0.2) for _ in range(10)] for _ in range(4)]
    rows = []
    for i in range(240):
        label = r.randrange(4)
        rows.append((i, [c + r.gauss(0, 0.15) for c in centre[label]][: r.choice([10, 10, 10, 4, 0])], label))
    rows += [(300, rows[0][1], 0), (300, rows[0][1], 0), (None, rows[1][1], 1), (302, [0.0] * 10, 2), (304, [-c for c in centre[3]], 3), (306, centre[1], 77)]
    bad = [(310, None, 1), (312, centre[0], None), (314, [None, 1.0], 1), (316, [float("nan")], 1), (318, [float("inf"), 0.1], 1)]
    df = spark.createDataFrame([(*x, "block", 7) for x in rows + bad], "vec_id long, embedding array<double>, label int, block string, row int")
    got = hard_negatives.mine_negatives(df.repartition(3), F.col("vec_id") % 6 == 0, rule).drop("positive_rank")
    want = plain_negatives([(*x, x[0] is not None and x[0] % 6 == 0) for x in rows], rule)
    # Rows of one id are told apart by place only, which the shuffle above settles; what is seen of them is equal.
    assert len(want) > 100 and Counter(map(tuple, got.collect())) == Counter(want)
    assert hard_negatives.mine_negatives(df.limit(0), F.col("vec_id") % 6 == 0).collect() == []


def test_too_large_components_fail(spark):
    df = spark.createDataFrame([(0, [1e30], 1), (1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="2\\*\\*26"):
        hard_negatives.mine_negatives(df, F.col("vec_id") == 0).collect()


def test_index_omits_and_lowers():
    """The lists leave out suffixes, and every threshold gives all scores from it on."""
    r = np.random.default_rng(5)
    x = np.floor(r.normal(0, 40, (300, 24)) * np.linspace(2, 0.05, 24))
    q = np.floor(r.normal(0, 40, 24))
    index = hard_negatives.Index(x, 12_000.0, float(np.sqrt((q * q).sum())), 4)
    assert sum(len(values) for _, values in index.lists) < 0.8 * len(index.lists) * len(x)
    for threshold in (60_000, 30_000, 12_000):
        rows, scores = index.search(q, [80_000, threshold], lambda rows, s, t: t == threshold)
        assert dict(zip(rows.tolist(), scores.tolist())).items() >= {(i, s) for i, s in enumerate((x @ q).tolist()) if s >= threshold}
        assert (x[rows] @ q == scores).all()


# --- phrases -------------------------------------------------------------------------------------------


def plain_counts(rows, rule):
    counts, words = Counter(), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            found = re.findall(r"[^\x20\x09]+", piece)
            words[lang or "und"] += len(found)
            for k in range(1, rule.longest + 1):
                counts.update((lang or "und", " ".join(found[i : i + k])) for i in range(len(found) - k + 1))
    return {k: n for k, n in counts.items() if n >= rule.least_count}, words


def plain_phrases(rows, rule):
    counts, words = plain_counts(rows, rule)
    out = defaultdict(list)
    for (lang, phrase), a in counts.items():
        parts = phrase.split(" ")
        if len(parts) == 1 or any(
            lang == other and len(y.split(" ")) > len(parts) and f" {phrase} " in f" {y} " and 100 * n >= rule.contained_percent * a for (other, y), n in counts.items()
        ):
            continue
        cut = []
        for k in range(1, len(parts)):
            left, right = counts[lang, " ".join(parts[:k])], counts[lang, " ".join(parts[k:])]
            cut.append((1000 * a * words[lang] // (left * right), k, left, right))
        score, _, left, right = min(cut)
        out[lang].append((-score, -a, phrase.encode(), left, right))
    return {
        (lang, i + 1, p.decode(), -a, left, right, words[lang], -s)
        for lang, found in out.items()
        for i, (s, a, p, left, right) in enumerate(sorted(found)[: rule.top])
    }


def phrase_texts():
    r = random.Random(6)
    words = [f"w{i}" for i in range(12)] + ["Ünter", "A\u00a0B", "x\x1fy"]
    rows = []
    for _ in range(150):
        text = " ".join(r.choice(words) if r.random() < 0.6 else "new york stock exchange today" for _ in range(r.randrange(40)))
        rows.append((r.choice(["en", "en", "fr", None]), re.sub(" ", lambda m: r.choice([" "] * 12 + ["  ", "\t", ". ", ",", "\r\n", "\x0b"]), text)))
    return rows + [("en", None), ("en", ""), ("de", " .,;"), ("en", "a b a b a a a a a a a a a a " * 9)] + [("fr", "New York City")] * 40


@pytest.mark.parametrize(
    "rule",
    [
        collocations.Rule(least_count=12, shards=3, top=25),
        collocations.Rule(least_count=4, shards=2, map_bits=1 << 15, words_held=20, contained_percent=60),
    ],
)
def test_phrases_equal_plain_counts(spark, rule):
    rows = phrase_texts()
    df = spark.createDataFrame([(lang, text, "phrase", 3) for lang, text in rows], "lang string, text string, phrase string, n int").repartition(5)
    want, words = plain_counts(rows, rule)
    counts, n = collocations.count_phrases(df, rule)
    assert {(r["lang"], r["phrase"]): r["a"] for r in counts.collect()} == want
    assert {r["lang"]: r["n"] for r in n.collect()} == {k: v for k, v in words.items() if v}
    assert set(map(tuple, collocations.mine_phrases(df, rule).collect())) == plain_phrases(rows, rule)


def test_scan_sends_a_row_for_each_range_not_each_phrase(spark):
    rows = phrase_texts()
    df = spark.createDataFrame([(lang or "und", text or "") for lang, text in rows], "lang string, text string").repartition(5)
    rule = collocations.Rule(least_count=1, longest=3, map_bits=1 << 15)
    chunks = collocations._numbered(df, rule)
    maps = spark.sparkContext.broadcast((b"\xff" * (1 << 12),) * 2)
    got = collocations._scan(chunks, rule, 4, True, maps).collect()
    want, _ = plain_counts(rows, rule)
    # Words and longer phrases of a chunk are sent apart from each other.
    assert len(got) <= 2 * 4 * chunks.count() < len(want) / 10
    assert sum(np.frombuffer(r["counts"], np.int32).sum() for r in got) == sum(want.values())
    assert collocations._counted(chunks, rule, 4, maps).count() <= 4 * 4 * 5  # ranges, languages and tasks
    keys = [x + (r["part"] << 32) for r in got for x in np.frombuffer(r["keys"], np.uint32).tolist()]
    assert len(set(keys)) == len(want) and len({k for k in keys if k & 1}) == sum(p.count(" ") == 2 for _, p in want)


def test_phrases_of_nothing(spark):
    assert collocations.mine_phrases(spark.createDataFrame([], "lang string, text string")).collect() == []


def test_registered_queries_of_this_file(spark):
    """On the smallest tables, against the plain versions above."""
    pages = [(r["page_id"], *fit(r["url"], queries.URL_RULES)) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    got = queries.op11_host_reputation(spark, SF).collect()
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == Counter(p[:4] for p in pages)
    assert all(r["verdict"] == p for r in got for p in [dict((x[0], x[4]) for x in pages)[r["page_id"]]] if p)
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["vec_id"] % 50 == 0) for r in vectors]
    assert Counter(map(tuple, queries.op12_threshold_negatives(spark, SF).collect())) == Counter(plain_negatives(rows))
    docs = [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert set(map(tuple, queries.op13_itemset_phrases(spark, SF).collect())) == plain_phrases(docs, collocations.Rule())
