"""The registered queries of the operators, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chosen_path, collocations, hard_negatives, licenses, linededup, packing, pii, repetition, reputation, ring, templates, toxicity, warc
)
from .common import materialize, table

TOKENIZER, END_ID = "word_bpe_49k.json", 2
SHARDS = 40


def op1_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge_repetition(table(spark, sf_dir, "documents")).drop("n_covered_words", "longest_repeat")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op2_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)


def op3_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark, "warc")
    warc.write_archives(warc.with_file_rows(table(spark, sf_dir, "pages")), folder, least_bytes=0, row_col="_row")
    records = materialize(warc.read_archives(spark, folder).drop("payload"))
    captures = materialize(warc.assemble(records).filter("response IS NOT NULL"))
    page = F.col("metadata")[0]["page_id"]
    flat = captures.select(
        "capture_id",
        page.alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.col("response.refers_to").alias("urn"),
    )
    named = flat.filter("urn IS NULL").select(F.col("capture_id").alias("urn"), F.col("page_id").alias("refers_to"))
    again = flat.filter("urn IS NOT NULL")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    first = flat.filter("urn IS NULL").withColumn("refers_to", F.lit(None).cast("bigint"))
    return first.select(*columns).unionByName(again.join(named, "urn", "left").select(*columns))


def op4_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring.assign(table(spark, sf_dir, "documents"), SHARDS)


def op5_two_bloom_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.drop_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op7_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents"))
    every = F.array_sort(F.concat("base", "added"))
    return found.select(
        "doc_id",
        *[pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
        pii.span_text(every).alias("spans"),
    )


def op9_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def learnable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").filter(~toxicity.held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").alias("label"))


def op10_ftrl_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.score_toxicity(docs, learnable_labels(spark, sf_dir), docs)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


# The rules of the query: verdict, host and path.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op11_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the labels of the pages' ids: low quality or toxic is bad."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.expr("quality = 0 OR toxic = 1").alias("bad"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return reputation.judge_urls(pages, outcomes, reputation.rules_frame(spark, URL_RULES)).drop("rate", "lower")


def op12_threshold_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)
    return found.drop("positive_rank")


def op13_itemset_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_repetition, op2_vector_packing, op3_transactions, op4_bounded_ring, op5_two_bloom_lines, op6_license_sentences,
        op7_chosen_path_join, op8_weak_supervision, op9_template_leaks, op10_ftrl_toxicity, op11_host_reputation,
        op12_threshold_negatives, op13_itemset_phrases,
    )
}

SPACE = r"[\x20\x09-\x0D]"


def _repetition_sql(rule: repetition.Rule = repetition.Rule()) -> str:
    """Words that windows of w words cover which occur again are what repeats of at least w words cover."""

    def windows(name: str, size: int) -> str:
        return f"""
{name}_at AS (SELECT rid, unnest(range(1, len(w) - {size - 2})) AS i, w FROM d WHERE len(w) >= {size}),
{name}_n AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c
             FROM (SELECT rid, i, md5(array_to_string(w[i:i + {size - 1}], ' ')) AS g FROM {name}_at)),
{name} AS (SELECT rid, count(DISTINCT j) AS covered
           FROM (SELECT rid, unnest(range(i, i + {size})) AS j FROM {name}_n WHERE c > 1) GROUP BY rid)"""

    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
{windows('three', 3)}, {windows('long', rule.min_words)}, {windows('longest', rule.longest_words + 1)},
m AS (SELECT doc_id, len(w)::bigint AS n_words, length(regexp_replace(t, '{SPACE}', '', 'g'))::bigint AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::bigint AS n_dup_lines,
             coalesce(three.covered, 0)::bigint AS n_repeat_words, coalesce(long.covered, 0) AS long_words, longest.covered IS NOT NULL AS too_long
      FROM (SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d) d
      LEFT JOIN three USING (rid) LEFT JOIN long USING (rid) LEFT JOIN longest USING (rid)),
j AS (SELECT *, n_words < {rule.min_doc_words} OR 100 * n_repeat_words > {rule.window_percent} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * long_words <= {rule.covered_percent} * n_words AND NOT too_long AS kept FROM j"""


def _lines_sql(rule: linededup.Rule = linededup.Rule()) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT rid, i, line, translate(regexp_replace(regexp_replace(line, '^{SPACE}+', ''), '{SPACE}+$', ''), '{upper}', '{lower}') AS key FROM l),
often AS (SELECT key FROM k WHERE length(key) >= {rule.min_chars} GROUP BY key HAVING count(DISTINCT rid) >= {rule.min_docs}),
kept AS (SELECT rid, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM k WHERE key NOT IN (SELECT key FROM often) GROUP BY rid)
SELECT doc_id, len(lines)::bigint AS n_lines, (len(lines) - coalesce(n, 0))::bigint AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)"""


def _transactions_sql() -> str:
    return """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS bytes, sha1(html) AS hex, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, bytes::bigint AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(hex, 1 + 10 * (i // 8), 10))::bigint >> (35 - 5 * (i % 8))::int) & 31)::int + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h"""


def _licenses_sql() -> str:
    known = ", ".join(f"('{text}', '{name}')" for name, text in licenses.SENTENCES.items())
    rules = ", ".join(f"('{lic}', {list(ids)!r})" for lic, ids in licenses.RULES)
    return rf"""
WITH known(sentence, name) AS (VALUES {known}), rules(license, ids) AS (VALUES {rules}),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             list_filter(regexp_split_to_array(coalesce(text, ''), '[.;:!?]+[ \t\r]|\n'), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS parts FROM documents),
s AS (SELECT rid, unnest(parts) AS part, generate_subscripts(parts, 1) - 1 AS pos FROM d),
f AS (SELECT rid, pos, name, row_number() OVER (PARTITION BY rid ORDER BY pos) AS k
      FROM (SELECT rid, pos, lower(trim(regexp_replace(part, '[^A-Za-z0-9]+', ' ', 'g'))) AS sentence FROM s) JOIN known USING (sentence)),
seq AS (SELECT rid, list(name ORDER BY k) AS names, list(pos ORDER BY k) AS ats FROM f GROUP BY rid),
hit AS (SELECT rid, license, len(ids) AS n, k, ats[k] AS first, ats[k + len(ids) - 1] AS last
        FROM (SELECT rid, names, ats, unnest(range(1, len(names) + 1)) AS k FROM seq) CROSS JOIN rules WHERE names[k:k + len(ids) - 1] = ids)
SELECT doc_id, license, n::bigint AS n_sentences, first::bigint AS first_sentence, last::bigint AS last_sentence, len(parts)::bigint AS text_sentences
FROM hit a JOIN d USING (rid)
WHERE NOT EXISTS (SELECT 1 FROM hit b WHERE b.rid = a.rid AND b.n > a.n AND b.k < a.k + a.n AND a.k < b.k + b.n)"""


def _hosts_sql(rule: reputation.Rule = reputation.Rule()) -> str:
    def level(name: str, parent: str, keys: str) -> str:
        """Rates of a level: the size of the prior from the scatter around the parents' rates, then the shrunk rates."""
        return f"""
{name}_prior AS (SELECT 1 / least(greatest(coalesce(sum(power(bad - n * mean, 2) - n * (mean * (1 - mean))) / nullif(sum(n * (n - 1) * (mean * (1 - mean))), 0),
                 {rule.most_spread}), {rule.least_spread}), {rule.most_spread}) - 1 AS prior FROM {parent}),
{name}_rate AS (SELECT {keys}, (mean * prior + bad) / (prior + n) AS rate, prior + n AS size FROM {parent}, {name}_prior)"""

    several = ", ".join(f"'{s}'" for s in reputation.SUFFIXES)
    given = ", ".join(f"('{v}', '{r}')" for v, r in URL_RULES)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH rules AS (SELECT v, r, regexp_extract(r, '^[^/]*') AS rh, regexp_replace(r, '^[^/]*', '') AS rp FROM (VALUES {given}) x(v, r)),
u AS (SELECT row_number() OVER () AS rid, page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{upper}', '{lower}') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
hit AS (SELECT rid, v, r FROM u JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(r) DESC, length(rh) DESC, v DESC) = 1),
h AS (SELECT host, count(*) FILTER (bad IS NOT NULL) AS n, count(*) FILTER (bad) AS bad
      FROM u LEFT JOIN (SELECT doc_id, quality = 0 OR toxic = 1 AS bad FROM labels) l ON doc_id = page_id GROUP BY host),
named AS (SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), '[.]?(:[0-9]*)?$', '') AS site, n, bad FROM h),
s AS (SELECT site, string_split(site, '.') AS parts, sum(n) AS n, sum(bad) AS bad FROM named WHERE site <> '' GROUP BY site),
t AS (SELECT *, regexp_matches(site, '^([0-9]+([.][0-9]+){{3}}|\[.*\])$') AS address, array_to_string(parts[-2:], '.') IN ({several}) AS two FROM s),
sites AS (SELECT site, n, bad, CASE WHEN address THEN site ELSE array_to_string(parts[(CASE WHEN two THEN -2 ELSE -1 END):], '.') END AS suffix,
                 CASE WHEN address THEN site ELSE array_to_string(parts[(CASE WHEN two THEN -3 ELSE -2 END):], '.') END AS domain FROM t),
every AS (SELECT coalesce(sum(n), 0) AS n, (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS rate FROM sites),
tops AS (SELECT suffix, sum(sites.n) AS n, sum(bad) AS bad, any_value(every.rate) AS mean FROM sites, every GROUP BY suffix), {level("top", "tops", "suffix")},
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS mean FROM sites JOIN top_rate USING (suffix) GROUP BY suffix, domain),
{level("domain", "domains", "suffix, domain")},
low AS (SELECT site, n, bad, rate AS mean FROM sites JOIN domain_rate USING (suffix, domain)), {level("site", "low", "site")},
judged AS (SELECT host, coalesce(s.rate, every.rate) AS rate, coalesce(s.size, every.n + 2) AS size, every.n AS n
           FROM named LEFT JOIN site_rate s USING (site) CROSS JOIN every)
SELECT page_id, host, path, r AS rule,
       coalesce(v, CASE WHEN n > 0 AND rate - {rule.deviations} * sqrt(rate * (1 - rate) / (size + 1)) > {rule.most_bad} THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN hit USING (rid) JOIN judged USING (host)"""


def _negatives_sql(rule: hard_negatives.Rule = hard_negatives.Rule()) -> str:
    return f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor({rule.scale} * x::double)) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS (SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::bigint AS score
      FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, rid) <= {rule.positives}),
n AS (SELECT anchor, p.anchor_id, p.rid AS positive, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score, s.rid
      FROM p JOIN s USING (anchor) WHERE NOT s.same AND {rule.low_percent} * p.score <= 100 * s.score AND 100 * s.score <= {rule.high_percent} * p.score)
SELECT anchor_id, positive_id, row_number() OVER w::int AS rank, negative_id, positive_score, negative_score FROM n
WINDOW w AS (PARTITION BY anchor, positive ORDER BY negative_score DESC, negative_id, rid) QUALIFY row_number() OVER w <= {rule.negatives}"""


def _phrases_sql(rule: collocations.Rule = collocations.Rule()) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    sizes = ", ".join(f"({k})" for k in range(1, rule.longest + 1))
    return rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?
-
]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p),
g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w CROSS JOIN (VALUES {sizes}) t(k)),
c AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM g GROUP BY ALL),
f AS (SELECT * FROM c WHERE a >= {rule.least_count}),
n AS (SELECT lang, sum(a) AS n FROM c WHERE k = 1 GROUP BY lang),
held AS (SELECT DISTINCT x.lang, x.phrase FROM f x JOIN f y ON x.lang = y.lang AND y.k > x.k AND 100 * y.a >= {rule.contained_percent} * x.a
         AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' ') WHERE x.k > 1),
parts AS (SELECT lang, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS j FROM f ANTI JOIN held USING (lang, phrase) WHERE k > 1),
cuts AS (SELECT s.lang, s.phrase, s.a, j, l.a AS l, r.a AS r, n.n, (1000::hugeint * s.a::hugeint * n.n::hugeint) // (l.a::hugeint * r.a::hugeint) AS score
         FROM parts s JOIN f l ON l.lang = s.lang AND l.phrase = array_to_string(w[:j], ' ')
         JOIN f r ON r.lang = s.lang AND r.phrase = array_to_string(w[j + 1:], ' ') JOIN n ON n.lang = s.lang),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER o::bigint AS rank, phrase, a::bigint AS a, l::bigint AS l, r::bigint AS r, n::bigint AS n, score::bigint AS score FROM low
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= {rule.top}"""


ORACLES = {
    "op1_suffix_repetition": _repetition_sql(),
    "op3_transactions": _transactions_sql(),
    "op5_two_bloom_lines": _lines_sql(),
    "op6_license_sentences": _licenses_sql(),
    "op11_host_reputation": _hosts_sql(),
    "op12_threshold_negatives": _negatives_sql(),
    "op13_itemset_phrases": _phrases_sql(),
}
# Modules whose functions run in Python workers.
WORKER_MODULES = (chosen_path, collocations, hard_negatives, licenses, linededup, packing, repetition, templates, toxicity, warc)
