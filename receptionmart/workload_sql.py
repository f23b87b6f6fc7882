"""The registered queries as SQL for another engine, written from the rules alone.

Word boundaries there are ASCII-only. ``_marked`` puts underscores around every other character, which
makes it part of a word, and ``_unmarked`` takes them off again.
"""

from __future__ import annotations

from .workload import EXACT_SIZE, HIGH_SCORE, TABLES, UNMAPPED_SIZE


def _artist(key: str) -> str:
    return f"'Part#' || lpad({key}::varchar, 9, '0')"


SCORE = "round(o_totalprice / 5000) / 10"
K = "json_extract_string(props, '$.k')::double"

BASE = f"""
reviews AS (SELECT o_orderkey AS reviewid, o_orderpriority AS title, year(o_orderdate)::int AS pub_year,
                   month(o_orderdate)::int AS pub_month, {SCORE} AS score FROM orders),
bridge AS (SELECT DISTINCT l_orderkey AS reviewid, {_artist('l_partkey')} AS artist FROM lineitem),
dim AS (SELECT {_artist('p_partkey')} AS artist,
               CASE WHEN p_size > {UNMAPPED_SIZE} THEN {_artist('p_partkey')} END AS artist_spotify,
               CASE WHEN p_size > {UNMAPPED_SIZE} AND p_size >= {EXACT_SIZE} THEN 'exact_norm'
                    WHEN p_size > {UNMAPPED_SIZE} THEN 'jaccard_token' ELSE '' END AS match_type,
               CASE WHEN p_size > {UNMAPPED_SIZE} AND p_size >= {EXACT_SIZE} THEN 1.0::double
                    WHEN p_size > {UNMAPPED_SIZE} THEN 0.75::double ELSE 0.0::double END AS score FROM part),
tracks AS (SELECT {_artist('user_id')} AS artist, event_type AS song, {K} / 100 AS danceability, {K} / 50 AS energy,
                  {K} / 20 AS valence, value AS streams, {K} AS yt_views,
                  CASE WHEN event_type <> 'error' THEN {K} END AS yt_likes, {K} * 2 AS yt_comments FROM events),
rwa AS (SELECT r.reviewid, r.title, r.pub_year, r.pub_month, r.score, b.artist AS bridge_artist,
               d.artist_spotify, d.match_type, d.score AS match_conf
        FROM bridge b JOIN reviews r USING (reviewid) LEFT JOIN dim d ON d.artist = b.artist)"""


def _sum(c: str) -> str:
    return f"sum(round({c} * 100)::bigint)::double / 100.0"


def _avg(c: str) -> str:
    return f"sum(round({c} * 100)::bigint)::double / nullif(count({c}), 0) / 100.0"


SUMMARY = f"""summary AS (
SELECT artist_spotify AS artist, count(DISTINCT reviewid) AS review_count, {_avg('score')} AS avg_score, min(score) AS min_score,
       max(score) AS max_score, min(pub_year) AS first_review_year, max(pub_year) AS last_review_year
FROM rwa WHERE artist_spotify IS NOT NULL GROUP BY 1)"""
STREAMS = f"""streams AS (
SELECT artist, count(*) AS track_count, {_sum('streams')} AS total_streams, {_avg('streams')} AS avg_streams_per_track,
       {_sum('yt_views')} AS total_yt_views, {_avg('yt_views')} AS avg_yt_views_per_track, {_sum('yt_likes')} AS total_yt_likes,
       {_sum('yt_comments')} AS total_yt_comments, {_avg('danceability')} AS avg_danceability, {_avg('energy')} AS avg_energy,
       {_avg('valence')} AS avg_valence
FROM tracks GROUP BY artist)"""
MART_COLUMNS = [
    "artist", "review_count", "avg_score", "min_score", "max_score", "first_review_year", "last_review_year", "track_count",
    "total_streams", "avg_streams_per_track", "total_yt_views", "avg_yt_views_per_track", "total_yt_likes", "total_yt_comments",
    "avg_danceability", "avg_energy", "avg_valence",
]
MART = f"""{BASE}, {SUMMARY}, {STREAMS},
mart AS (SELECT c.*, s.* EXCLUDE (artist) FROM summary c LEFT JOIN streams s ON c.artist = s.artist),
frame AS (SELECT *, log10(total_streams) AS log10_total_streams,
                 CASE WHEN avg_streams_per_track <> 0 THEN log10(avg_streams_per_track) END AS log10_avg_streams_per_track
          FROM mart WHERE avg_score IS NOT NULL AND total_streams > 0),
core AS (SELECT * FROM frame WHERE review_count >= 2 AND track_count >= 5)"""


def _pair(a: str, b: str, of: str) -> str:
    return f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", round(corr({a}, {b}), 6) AS correlation FROM {of}"


def _correlations(columns: list[str], of: str) -> str:
    return " UNION ALL ".join(_pair(a, b, of) for i, a in enumerate(columns) for b in columns[i:])


def _profile(columns: dict[str, str], of: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, min({c})::double AS \"min\", round(quantile_cont({c}::double, 0.25), 6) AS q1, "
        f"round(quantile_cont({c}::double, 0.5), 6) AS median, round(quantile_cont({c}::double, 0.75), 6) AS q3, "
        f"max({c})::double AS \"max\" FROM {of}"
        for c, t in columns.items()
    )


TYPES = {c: "double" for c in MART_COLUMNS[1:]} | {
    "review_count": "bigint", "track_count": "bigint", "first_review_year": "int", "last_review_year": "int",
}


# --- names ------------------------------------------------------------------------------------------------


def _marked(c: str) -> str:
    return rf"regexp_replace({c}, '([^\x00-\x7F])', '_\1_', 'g')"


def _unmarked(c: str) -> str:
    return rf"regexp_replace({c}, '_([^\x00-\x7F])_', '\1', 'g')"


def _folded(c: str) -> str:
    return f"replace(lower({c}), 'ß', 'ss')"


def _squeezed(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


SEPARATOR = r"(?i)\s*(?:,|&|/|\+|\band\b|\bfeat\.?\b|\bfeaturing\b|\bwith\b)\s*"
COMPANY = r"(?i)\b(records?|recordings?|music|entertainment|studios?|llc|inc|ltd)\b"


def _credits(c: str) -> str:
    parts = f"regexp_split_to_array({_marked(_squeezed(c))}, '{SEPARATOR}')"
    named = f"list_transform({parts}, lambda p: trim({_unmarked('p')}))"
    return f"list_filter({named}, lambda p: length(p) > 2 OR lower(p) IN ('x', 'u2', 'm', 'bj', 'om', 'vv', 'xx'))"


def _universe_key(c: str) -> str:
    return _folded(_squeezed(_unmarked(rf"regexp_replace({_marked(c)}, '(?i)\b(feat\.?|ft\.?)\b.*$', '')")))


def _candidate_key(c: str) -> str:
    bare = _unmarked(rf"regexp_replace({_marked(c)}, '(?i)\b(feat\.?|ft\.?|featuring)\b.*$', '')")
    quoted = f"regexp_replace({bare}, '[’`'']', '', 'g')"
    return _folded(rf"trim(regexp_replace({quoted}, '[\s._\-]+', ' ', 'g'))")


def _is_company(c: str) -> str:
    return f"regexp_matches({_marked(c)}, '{COMPANY}')"


def _tokens(c: str) -> str:
    return f"list_sort(list_distinct(regexp_extract_all({c}, '[a-z0-9]+')))"


def _bucket(c: str) -> str:
    return f"CASE WHEN regexp_extract({c}, '[a-z0-9]') = '' THEN '_' ELSE regexp_extract({c}, '[a-z0-9]') END"


CREDITED = f"""
credited AS (SELECT doc_id AS reviewid, {_credits('text')} AS names FROM documents),
named AS (SELECT DISTINCT reviewid, artist FROM (SELECT reviewid, unnest(names) AS artist FROM credited))"""
UNIVERSE = rf"""{CREDITED},
counted AS (SELECT artist, count(*) AS n FROM named GROUP BY 1),
compound AS (SELECT trim(unnest(regexp_split_to_array(artist, '\s*[&,+/]\s*'))) AS artist, n FROM counted),
spelled AS (SELECT artist, sum(n)::bigint AS n_reviews FROM compound WHERE artist <> '' GROUP BY 1),
keyed AS (SELECT artist, n_reviews, {_universe_key('artist')} AS artist_norm FROM spelled),
universe AS (SELECT artist, n_reviews, artist_norm, artist_norm = 'various artists' AS is_various,
                    length(artist) <= 2 AS is_suspicious_token
             FROM (SELECT *, row_number() OVER (PARTITION BY artist_norm ORDER BY n_reviews DESC, artist) AS rn FROM keyed)
             WHERE rn = 1)"""
CANDIDATES = rf"""
listed AS (SELECT unnest({_credits('html')}) AS name FROM pages
           UNION ALL SELECT unnest(string_split(text, ';')) FROM conversations),
cand_names AS (SELECT DISTINCT regexp_replace(name, '^\s+|\s+$', '', 'g') AS name FROM listed),
candidates AS (SELECT {_candidate_key('name')} AS artist_norm, min(name) AS artist_spotify FROM cand_names
               WHERE name <> '' AND NOT {_is_company('name')} GROUP BY 1 HAVING {_candidate_key('name')} <> '')"""
EXACT = f"""{UNIVERSE}, {CANDIDATES},
matchable AS (SELECT * FROM universe WHERE NOT is_various AND NOT is_suspicious_token),
exact AS (SELECT u.artist, u.artist_norm, u.n_reviews, c.artist_spotify,
                 CASE WHEN c.artist_spotify IS NULL THEN '' ELSE 'exact_norm' END AS match_type,
                 CASE WHEN c.artist_spotify IS NULL THEN 0.0::double ELSE 1.0::double END AS score
          FROM matchable u LEFT JOIN candidates c USING (artist_norm))"""
MAPPED = f"""{EXACT},
cand_sets AS (SELECT artist_norm AS ckey, artist_spotify AS cname, {_bucket('artist_norm')} AS bucket, {_tokens('artist_norm')} AS toks FROM candidates),
open_sets AS (SELECT artist_norm AS ukey, {_bucket('artist_norm')} AS bucket, {_tokens('artist_norm')} AS toks
              FROM exact WHERE artist_spotify IS NULL AND artist_norm <> ''),
scoped AS (SELECT ukey, toks, CASE WHEN bucket IN (SELECT bucket FROM cand_sets) THEN bucket ELSE '*' END AS scope FROM open_sets),
cand_scoped AS (SELECT ckey, cname, toks, bucket AS scope FROM cand_sets UNION ALL SELECT ckey, cname, toks, '*' FROM cand_sets
                WHERE (SELECT count(*) FROM scoped WHERE scope = '*') > 0),
shared AS (SELECT u.ukey, c.ckey, count(*) AS o
           FROM (SELECT ukey, scope, unnest(toks) AS t FROM scoped) u JOIN (SELECT ckey, scope, unnest(toks) AS t FROM cand_scoped) c
             ON u.scope = c.scope AND u.t = c.t GROUP BY 1, 2),
scored AS (SELECT s.ukey, s.ckey, c.cname, s.o::double / (len(u.toks) + len(c.toks) - s.o) AS score
           FROM shared s JOIN scoped u USING (ukey) JOIN cand_sets c USING (ckey)),
best AS (SELECT ukey, cname, score FROM (
           SELECT *, row_number() OVER (PARTITION BY ukey ORDER BY score DESC, ckey) AS rn FROM scored WHERE score >= 0.65) WHERE rn = 1),
mapped AS (SELECT e.artist, e.artist_norm, e.n_reviews, coalesce(e.artist_spotify, b.cname) AS artist_spotify,
                  CASE WHEN b.ukey IS NOT NULL THEN 'jaccard_token' ELSE e.match_type END AS match_type,
                  CASE WHEN b.ukey IS NOT NULL THEN b.score ELSE e.score END AS score
           FROM exact e LEFT JOIN best b ON e.artist_norm = b.ukey)"""

CLEAN_NAME = r"regexp_replace(regexp_replace(lower(name), '^the ', ''), '[^\p{L}\p{N}\s]+', '', 'g')"


# --- weighted ratio ---------------------------------------------------------------------------------------

CUTOFF = 93.0
# Largest share of both lengths that may be edited for the plain ratio, and for the token ratio (which counts at 95 percent).
PLAIN_EDITS = f"(1 - {CUTOFF} / 100 + 1e-9)"
TOKEN_EDITS = f"(1 - {CUTOFF} / 95 + 1e-9)"
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"


def _letters(form: str, prefix: str) -> str:
    return ", ".join(f"(length({form}) - length(replace({form}, '{c}', '')))::int AS {prefix}{c}" for c in LETTERS)


def _letter_gap(prefix: str) -> str:
    """Difference of the letter counts; an insertion or deletion changes it by at most one."""
    return " + ".join(f"abs(a.{prefix}{c} - b.{prefix}{c})" for c in LETTERS)


def _edits(s: str, t: str, most: str) -> str:
    """Insertions and deletions between two lists of characters, or a larger number where there are more than ``most``.

    Dynamic programming by antidiagonals: the state has one cell for each difference of the two positions that ``most``
    edits can reach, and step d rewrites the cells of its parity from the two antidiagonals before it.
    """
    k = f"(x - {most} - 1)"
    i, j = f"((d[1] + {k}) // 2)", f"((d[1] - {k}) // 2)"
    beside = f"least(coalesce(v[x - 1], {most} + 1), coalesce(v[x + 1], {most} + 1)) + 1"
    cell = f"""CASE WHEN (d[1] + {k}) % 2 <> 0 THEN v[x]
WHEN {i} < 0 OR {j} < 0 OR {i} > len({s}) OR {j} > len({t}) THEN {most} + 1
WHEN {i} > 0 AND {j} > 0 AND {s}[{i}] = {t}[{j}] THEN v[x] ELSE least({beside}, {most} + 1) END"""
    start = f"list_transform(range(1, 2 * {most} + 2), lambda x: CASE WHEN x = {most} + 1 THEN 0::bigint ELSE {most} + 1 END)"
    steps = f"list_transform(range(1, len({s}) + len({t}) + 1), lambda x: [x])"
    table = f"list_reduce(list_concat([{start}], {steps}), lambda v, d: list_transform(range(1, 2 * {most} + 2), lambda x: {cell}))"
    return f"({table})[len({s}) - len({t}) + {most} + 1]"


def _names(source: str) -> str:
    return f"SELECT DISTINCT name, {CLEAN_NAME} AS clean FROM {source} WHERE {CLEAN_NAME} <> ''"


def _forms(source: str) -> str:
    return rf"""SELECT clean, length(clean) AS n, words, bag, array_to_string(bag, ' ') AS shelf, kinds, array_to_string(kinds, ' ') AS label,
length(array_to_string(kinds, ' ')) AS kinds_n, floor(ln(length(clean)) / ln(1.500001))::int AS band, {_letters('clean', 'p_')}, {_letters("array_to_string(kinds, ' ')", 'k_')}
FROM (SELECT clean, words, list_sort(words) AS bag, list_sort(list_distinct(words)) AS kinds
      FROM (SELECT clean, list_filter(regexp_split_to_array(clean, '\s+'), lambda w: w <> '') AS words FROM {source}))"""


def _held(inner: str, outer: str) -> str:
    """Pairs in which one side has nearly all words of the other: one of its rarest words is there."""
    return f"""SELECT DISTINCT {'i.clean, o.clean' if inner == 'la' else 'o.clean, i.clean'} FROM
(SELECT clean, n, band, unnest(list_transform(list_slice(list_sort(list_transform(kinds, lambda w: {{'uses': coalesce(map_extract_value(u.uses, w), 0), 'word': w}})),
        1, floor(kinds_n * {TOKEN_EDITS})::int + 1), lambda r: r.word)) AS word FROM {inner}, u) i
JOIN (SELECT clean, n, band, unnest(kinds) AS word FROM {outer}) o ON i.word = o.word AND abs(i.band - o.band) <= 1
WHERE greatest(i.n, o.n) < 1.5 * least(i.n, o.n)"""


WEIGHTED = rf"""{CREDITED},
pf AS ({_names('(SELECT DISTINCT artist AS name FROM named)')}),
sp AS (SELECT clean, min(name) AS name FROM ({_names(f"(SELECT unnest({_credits('html')}) AS name FROM pages)")}) GROUP BY 1),
la AS MATERIALIZED ({_forms('(SELECT DISTINCT clean FROM pf WHERE clean NOT IN (SELECT clean FROM sp))')}),
rb AS MATERIALIZED ({_forms('sp')}),
used AS (SELECT w, count(*) AS uses FROM (SELECT unnest(kinds) AS w FROM la UNION ALL SELECT unnest(kinds) FROM rb) GROUP BY 1),
u AS MATERIALIZED (SELECT map(list(w), list(uses)) AS uses FROM used),
near AS (SELECT a.clean AS x, b.clean AS y
         FROM (SELECT *, unnest([band - 1, band, band + 1]) AS at FROM la) a JOIN rb b ON a.at = b.band
         WHERE greatest(a.n, b.n) < 1.5 * least(a.n, b.n)
           AND (({_letter_gap('p_')}) <= (a.n + b.n) * {PLAIN_EDITS}
                OR (abs(a.kinds_n - b.kinds_n) <= (a.kinds_n + b.kinds_n) * {TOKEN_EDITS} AND ({_letter_gap('k_')}) <= (a.kinds_n + b.kinds_n) * {TOKEN_EDITS}))),
met AS MATERIALIZED (SELECT DISTINCT x, y FROM (SELECT x, y FROM near UNION ALL {_held('la', 'rb')} UNION ALL {_held('rb', 'la')})),
both_sides AS MATERIALIZED (
  SELECT x, y, a.words AS wa, b.words AS wb, a.shelf AS sa, b.shelf AS sb,
         list_filter(a.kinds, lambda w: NOT list_contains(b.kinds, w)) AS oa, list_filter(b.kinds, lambda w: NOT list_contains(a.kinds, w)) AS ob,
         len(list_intersect(a.kinds, b.kinds)) AS n_both, length(array_to_string(list_intersect(a.kinds, b.kinds), ' ')) AS shared
  FROM met JOIN la a ON a.clean = x JOIN rb b ON b.clean = y),
rest AS MATERIALIZED (
  SELECT *, array_to_string(oa, ' ') AS ra, array_to_string(ob, ' ') AS rb, (n_both > 0)::int AS gap FROM both_sides),
texts AS (
  SELECT x AS s, y AS t, floor((length(x) + length(y)) * {PLAIN_EDITS})::bigint AS most FROM rest
  UNION SELECT sa, sb, floor((length(sa) + length(sb)) * {TOKEN_EDITS})::bigint FROM rest
  UNION SELECT ra, rb, floor((2 * shared + 2 * gap + length(ra) + length(rb)) * {TOKEN_EDITS})::bigint FROM rest),
pairs AS (SELECT s, t, most, string_split(s, '') AS cs, string_split(t, '') AS ct FROM texts WHERE s <> '' AND t <> '' AND abs(length(s) - length(t)) <= most),
apart AS MATERIALIZED (SELECT s, t, most, {_edits('cs', 'ct', 'most')} AS edits FROM pairs),
fits AS (SELECT s, t, most, edits FROM apart WHERE edits <= most),
sims AS (
  SELECT r.x, r.y,
         100.0::double - 100.0::double * p.edits / (length(r.x) + length(r.y)) AS plain,
         100.0::double - 100.0::double * q.edits / (length(sa) + length(sb)) AS sorted_words,
         CASE WHEN n_both > 0 AND (ra = '' OR rb = '') THEN 100.0::double END AS contained,
         100.0::double - 100.0::double * o.edits / (2 * shared + 2 * gap + length(ra) + length(rb)) AS rests,
         CASE WHEN n_both > 0 THEN 100.0::double - 100.0::double * (gap + length(ra)) / (2 * shared + gap + length(ra)) END AS left_more,
         CASE WHEN n_both > 0 THEN 100.0::double - 100.0::double * (gap + length(rb)) / (2 * shared + gap + length(rb)) END AS right_more
  FROM rest r LEFT JOIN fits p ON p.s = r.x AND p.t = r.y AND p.most = floor((length(r.x) + length(r.y)) * {PLAIN_EDITS})::bigint
  LEFT JOIN fits q ON q.s = sa AND q.t = sb AND q.most = floor((length(sa) + length(sb)) * {TOKEN_EDITS})::bigint
  LEFT JOIN fits o ON o.s = ra AND o.t = rb AND o.most = floor((2 * shared + 2 * gap + length(ra) + length(rb)) * {TOKEN_EDITS})::bigint
  WHERE len(wa) > 0 AND len(wb) > 0),
scored AS (SELECT x, y, greatest(coalesce(plain, 0), 0.95::double * greatest(coalesce(sorted_words, 0), coalesce(contained, 0), coalesce(rests, 0),
                  coalesce(left_more, 0), coalesce(right_more, 0))) AS score FROM sims),
best AS (SELECT x, s.y, s.score, sp.name FROM scored s JOIN sp ON sp.clean = s.y WHERE s.score >= {CUTOFF}
         QUALIFY row_number() OVER (PARTITION BY x ORDER BY s.score DESC, sp.name, s.y) = 1),
matches AS (
  SELECT pf.name AS left_name, sp.name AS right_name, 100 AS score, clean AS left_clean, clean AS right_clean FROM pf JOIN sp USING (clean)
  UNION ALL SELECT pf.name, b.name, floor(b.score)::int, b.x, b.y FROM best b JOIN pf ON pf.clean = b.x),
lowered AS (SELECT *, lower(left_name) AS a, lower(right_name) AS b FROM matches),
worded AS (SELECT *, list_filter(list_distinct(regexp_split_to_array(a, '\s+')), lambda w: w <> '') AS ta,
                  list_filter(list_distinct(regexp_split_to_array(b, '\s+')), lambda w: w <> '') AS tb FROM lowered),
verdicts AS (SELECT *, NOT (a IN ('various artists', 'soundtrack', 'original soundtrack', 'va', 'ost') OR b IN ('various artists', 'soundtrack', 'original soundtrack', 'va', 'ost'))
  AND a[1] = b[1] AND least(length(a), length(b))::double / greatest(length(a), length(b)) >= 0.6
  AND NOT (len(ta) > 0 AND len(tb) > 0 AND len(list_intersect(ta, tb))::double / len(list_distinct(list_concat(ta, tb))) < 0.25 AND score < 95) AS accepted FROM worded)"""


# --- manifests --------------------------------------------------------------------------------------------

COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


# Arrays of numbers as whole numbers of 1 / 2^30.
ARRAY_FORMS = {
    "embedding": "array_to_string(list_transform(embedding, lambda x: coalesce(floor(x::double * 1073741824)::bigint::varchar, '-')), ',')"
}
# Names of types as the source profile lists them.
DTYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "FLOAT[]": "array<float>"}


def _dtype(table: str, column: str) -> str:
    cases = " ".join(f"WHEN '{theirs}' THEN '{ours}'" for theirs, ours in DTYPES.items())
    return f"(SELECT CASE any_value(typeof({column})) {cases} END FROM {table})"


def _fingerprint(table: str, source: str, replaced: dict[str, str] | None = None) -> str:
    columns = COLUMNS[table].split()
    forms = ARRAY_FORMS | (replaced or {})
    parts = ", ".join(f"coalesce(({forms.get(c, c)})::varchar, chr(0))" for c in columns)
    hashed = f"('0x' || substr(md5(concat_ws(chr(31), {parts})), 1, 15))::bigint::hugeint"
    return (
        f"SELECT '{table}' AS table_name, count(*) AS n_rows, {len(columns)}::int AS n_columns, "
        f"coalesce(sum({hashed}), 0)::varchar AS fingerprint FROM {source}"
    )


def _row_bytes(table: str) -> str:
    columns = COLUMNS[table].split()
    texts = ", ".join(f"coalesce(({ARRAY_FORMS.get(c, c)})::varchar, chr(0))" for c in columns)
    return f"strlen(concat_ws(chr(31), {texts}))"


def _all(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


DRIFT = f"""WITH o AS ({_all([_fingerprint(t, t) for t in ('orders', 'part', 'events', 'customer')])}),
n AS ({_all([_fingerprint('orders', "(SELECT * FROM orders WHERE o_orderstatus <> 'P') q"), _fingerprint('part', 'part'),
             _fingerprint('events', 'events', {'event_type': 'upper(event_type)'}), _fingerprint('supplier', 'supplier')])}),
j AS (SELECT coalesce(o.table_name, n.table_name) AS table_name, o.n_rows AS old_rows, n.n_rows AS new_rows,
             n.n_rows - o.n_rows AS delta_rows,
             CASE WHEN o.n_rows = 0 AND n.n_rows IS NOT NULL THEN 0.0 ELSE (n.n_rows - o.n_rows)::double / o.n_rows * 100 END AS delta_pct,
             CASE WHEN o.table_name IS NOT NULL AND n.table_name IS NOT NULL THEN o.fingerprint <> n.fingerprint END AS hash_changed,
             o.table_name IS NULL AS is_new, n.table_name IS NULL AS is_gone
      FROM o FULL JOIN n ON o.table_name = n.table_name)
SELECT table_name, old_rows, new_rows, delta_rows, round(delta_pct, 6) AS delta_pct, hash_changed,
       CASE WHEN is_new THEN 'added' WHEN is_gone THEN 'removed' WHEN delta_rows <> 0 OR hash_changed THEN 'changed' ELSE 'same' END AS status,
       coalesce(delta_pct < -2.0, false) AS fails FROM j"""

CLEAN_TRACKS = f"""SELECT DISTINCT {_artist('user_id')} AS artist, event_type AS song, {K} / 100 AS danceability, {K} / 50 AS energy,
{K} / 20 AS valence, {K} * 3 AS yt_views, {K} AS streams FROM events WHERE event_type <> 'error'"""
RAW_DATE = "CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') END"
CRITICAL = "SELECT artist, avg_score, review_count, total_streams FROM core"

PAIRS = """pairs AS (SELECT DISTINCT p_name, lower(p_type) AS p_type, p_size FROM part),
forms AS (SELECT *, lower(p_name) AS a, lower(split_part(p_name, ' ', 1) || ' ' || p_type) AS b, p_size + 50 AS s FROM pairs),
sets AS (SELECT *, list_distinct(string_split(a, ' ')) AS ta, list_distinct(string_split(b, ' ')) AS tb FROM forms)"""
BLOCKED = "('various artists', 'soundtrack', 'original soundtrack', 'va', 'ost')"

ORACLES: dict[str, str] = {
    "review_with_artist": f"WITH {BASE} SELECT * FROM rwa",
    "unmatched_artists": f"WITH {BASE} SELECT bridge_artist AS artist, count(*) AS n_reviews FROM rwa WHERE artist_spotify IS NULL GROUP BY 1",
    "coverage_by_year": f"""WITH {BASE},
seen AS (SELECT r.pub_year, x.artist, bool_or(d.artist_spotify IS NOT NULL) AS mapped
         FROM reviews r JOIN bridge x ON x.reviewid = r.reviewid LEFT JOIN dim d ON d.artist = x.artist WHERE x.artist IS NOT NULL GROUP BY 1, 2),
years AS (SELECT pub_year, count(*) AS n, count(*) FILTER (mapped) AS k FROM seen GROUP BY 1)
SELECT pub_year, n AS artists_total, k AS artists_mapped, ((2000 * k + n) // (2 * n))::double / 1000 AS pct_mapped FROM years""",
    "artist_summary": f"WITH {BASE}, {SUMMARY} SELECT * FROM summary",
    "artist_streams": f"WITH {BASE}, {STREAMS} SELECT * FROM streams",
    "artist_mart": f"WITH {MART} SELECT * FROM mart",
    "analysis_frame": f"WITH {MART} SELECT * REPLACE (round(log10_total_streams, 6) AS log10_total_streams, "
    "round(log10_avg_streams_per_track, 6) AS log10_avg_streams_per_track) FROM frame",
    "core_artists": f"WITH {MART} SELECT artist, review_count, avg_score, min_score, max_score, first_review_year, last_review_year, "
    "track_count, total_streams, total_yt_views, avg_danceability, avg_energy, avg_valence, round(log10_total_streams, 6) AS log10_total_streams FROM core",
    "correlation": f"WITH {MART} {_correlations(['avg_score', 'total_streams', 'log10_total_streams'], 'frame')}",
    "correlation_core": f"WITH {MART} {_correlations(['avg_score', 'log10_total_streams'], 'core')}",
    "underrated": f"WITH {MART} {CRITICAL} WHERE avg_score >= {HIGH_SCORE} AND log10_total_streams <= (SELECT quantile_cont(log10_total_streams, 0.3) FROM core)",
    "overrated": f"WITH {MART} {CRITICAL} WHERE avg_score <= 6.0 AND log10_total_streams >= (SELECT quantile_cont(log10_total_streams, 0.7) FROM core)",
    "profile": f"WITH {MART} {_profile({c: TYPES[c] for c in MART_COLUMNS[1:]}, 'mart')}",
    "quantiles": _all(
        [
            f"SELECT '{c}' AS metric, {p}::double AS probability, count({c}) AS n, round(quantile_cont({c}, {p}), 6) AS quantile FROM lineitem"
            for c in ("l_quantity", "l_extendedprice")
            for p in (0.25, 0.3, 0.7, 0.99)
        ]
    ),
    "top_artists": f"WITH {BASE} SELECT artist, count(*) AS n FROM bridge GROUP BY 1 ORDER BY n DESC, artist LIMIT 10",
    "unmatched_top": f"WITH {BASE} SELECT bridge_artist AS artist, count(*) AS n_reviews FROM rwa WHERE artist_spotify IS NULL GROUP BY 1 ORDER BY n_reviews DESC, artist LIMIT 20",
    "acclaimed_artists": f"WITH {MART} SELECT * FROM mart WHERE avg_score >= {HIGH_SCORE}",
    "reviewed_twice": f"WITH {MART} SELECT artist, avg_score, total_streams FROM mart WHERE review_count >= 2",
    "stage_reviews": f"""SELECT o_orderkey AS reviewid, o_orderpriority AS title, {SCORE} AS score,
(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::tinyint AS best_new_music, {RAW_DATE} AS pub_date,
year(o_orderdate)::smallint AS pub_year, month(o_orderdate)::tinyint AS pub_month, day(o_orderdate)::tinyint AS pub_day FROM orders""",
    "stage_checks": f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE {SCORE} < 0 OR {SCORE} > 10 OR o_totalprice IS NULL) AS bad_scores, "
    f"count(*) FILTER (WHERE {RAW_DATE} IS NULL) AS null_dates FROM orders",
    "clean_tracks": CLEAN_TRACKS,
    "split_credits": f"WITH {CREDITED} SELECT reviewid, unnest(range(len(names)))::bigint AS pos, unnest(names) AS artist FROM credited",
    "bridge_dedupe": f"WITH {CREDITED} SELECT * FROM named",
    "artist_universe": f"WITH {UNIVERSE} SELECT * FROM universe",
    "name_forms": f"""WITH {CREDITED}, names AS (SELECT DISTINCT artist AS name FROM named)
SELECT name, {_universe_key('name')} AS universe_key, {_candidate_key('name')} AS candidate_key, {CLEAN_NAME} AS cleaned,
{_is_company('name')} AS is_company, {_bucket(_candidate_key('name'))} AS bucket, len({_tokens(_candidate_key('name'))})::bigint AS n_tokens FROM names""",
    "json_candidates": f"WITH {CANDIDATES} SELECT * FROM candidates",
    "exact_match": f"WITH {EXACT} SELECT * FROM exact",
    "jaccard_match": f"WITH {MAPPED} SELECT * FROM mapped",
    "pair_verdicts": f"""WITH {PAIRS} SELECT p_name, p_type, p_size,
NOT (a IN {BLOCKED} OR b IN {BLOCKED}) AND a[1] = b[1] AND least(length(a), length(b))::double / greatest(length(a), length(b)) >= 0.6
AND NOT (len(list_intersect(ta, tb))::double / len(list_distinct(list_concat(ta, tb))) < 0.25 AND s < 95) AS accepted FROM sets""",
    "weighted_match": f"WITH {WEIGHTED} SELECT DISTINCT left_name AS pitchfork_artist, right_name AS spotify_artist, score FROM verdicts WHERE accepted",
    "review_queue": f"""WITH {WEIGHTED} SELECT DISTINCT left_name AS pf_artist, right_name AS sp_artist, score, left_clean AS pf_clean, right_clean AS sp_clean
FROM verdicts WHERE NOT accepted""",
    "dim_publish": f"WITH {MAPPED} SELECT row_number() OVER (ORDER BY artist_norm) AS artist_key, * FROM mapped",
    "dim_ranking": f"""SELECT artist, artist_norm, n_reviews, artist_spotify, match_type, score FROM (
SELECT {_artist('p_partkey')} AS artist, p_name AS artist_norm, p_size::bigint AS n_reviews, p_brand AS artist_spotify, p_type AS match_type, p_retailprice AS score,
row_number() OVER (PARTITION BY p_name ORDER BY p_retailprice DESC, coalesce(p_size, 0) DESC, p_partkey) AS rn FROM part) WHERE rn = 1""",
    "mapping_coverage": f"""WITH {BASE},
seen AS (SELECT x.artist, bool_or(d.artist_spotify IS NOT NULL) AS mapped, bool_or(d.match_type = 'exact_norm') AS exact,
                bool_or(d.match_type = 'jaccard_token') AS fuzzy FROM bridge x LEFT JOIN dim d ON d.artist = x.artist WHERE x.artist IS NOT NULL GROUP BY 1)
SELECT count(*) AS total_artists, count(*) FILTER (mapped) AS mapped_artists, count(*) FILTER (exact) AS exact_mapped,
       count(*) FILTER (fuzzy) AS fuzzy_mapped FROM seen""",
    "row_counts": _all([f"SELECT '{t}' AS tbl, count(*) AS n FROM {t}" for t in TABLES]),
    "score_range": f"SELECT min({SCORE}) AS min_score, max({SCORE}) AS max_score FROM orders",
    "null_checks": "SELECT count(*) FILTER (WHERE user_id IS NULL OR event_type IS NULL OR event_type = 'error') AS null_rows_spotify FROM events",
    "blank_artists": "SELECT count(*) FILTER (WHERE text IS NULL OR trim(text) = '') AS null_artists FROM documents",
    "orphans": "SELECT doc_id AS reviewid FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "duplicate_pairs": f"SELECT l_orderkey AS reviewid, {_artist('l_partkey')} AS artist, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "short_tokens": r"""SELECT artist, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS artist FROM conversations)
WHERE artist <> '' AND length(artist) <= 2 AND artist NOT IN ('x', 'u2', 'm', 'bj', 'om', 'vv', 'xx') GROUP BY 1""",
    "key_checks": "SELECT p_name AS artist_norm, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1",
    "manifest": _all([_fingerprint(t, t) for t in TABLES]),
    "manifest_drift": DRIFT,
    "manifest_totals": "SELECT count(*) AS tables_exported, sum(n)::bigint AS rows_exported, sum(size)::bigint AS bytes_exported "
    f"FROM ({_all([f'SELECT count(*) AS n, sum({_row_bytes(t)}) AS size FROM {t}' for t in TABLES])})",
    "source_profile": _all(
        [
            f"SELECT '{t}' AS table_name, {i}::int AS position, '{c}' AS column_name, {_dtype(t, c)} AS dtype, true AS nullable, (SELECT count(*) FROM {t}) AS n_rows"
            for t in TABLES
            for i, c in enumerate(COLUMNS[t].split())
        ]
    ),
}
