"""Personal data spans by weak supervision, in DataFrame functions only.

1. Base spans: leftmost non-overlapping matches of a pattern per kind, kept if they pass the kind's check.
2. Candidates: base matches, passing or not, and matches of looser patterns (spelled-out addresses, national phone
   numbers). Labelers vote for, against, or not at all: the strict pattern with its check; a gazetteer of top-level
   domains, country codes and issuer prefixes; words before the span; the signs around it; the shape of its digits.
3. Expectation-maximisation estimates from the votes how reliable each labeler is, per kind. It only needs the number of
   candidates per combination of votes, of which there are at most 3^5 per kind, so it runs on that table.
4. The final classifier is naive Bayes over span features (words before, signs, shape), trained on the estimated
   probabilities as soft labels. Its counts are one aggregation over a fixed set of feature values.
5. Candidates over the threshold that touch no base span are added to the base spans.

Texts are scanned once, without a shuffle; what is stored afterwards holds spans only, never text. Positions are code
points, the end exclusive; they are summed block by block, so time grows with the number of matches in a text, not its square. Patterns start at a run's beginning or where the last match ended, which finds the same
matches as the plain pattern and keeps long runs linear.

Defined cases: null and empty texts have no spans; texts of any length are read whole; every row is judged on its own,
repeated or not; without candidates nothing is trained and nothing added; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")
# Patterns of the base rules, with the start of a run marked. Repeated groups end the patterns, so they are
# possessive, which matches the same and doesn't use the stack for long runs.
EMAIL_SIGN, DIGIT = "[A-Za-z0-9._%+-]", "[0-9]"
BASE = {
    "email": rf"(?:\G|(?<!{EMAIL_SIGN})){EMAIL_SIGN}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?:\G|(?<!{DIGIT}))[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser patterns of candidates.
LOOSE = {
    "email": rf"(?i)(?:\G|(?<!{EMAIL_SIGN})){EMAIL_SIGN}+ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
}
# Signs that every match of a pattern contains; texts without them are not searched.
NEEDS = {"email": "@", "phone": "+"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# Gazetteers and cue words.
DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|co"
COUNTRY = "1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
ISSUER = "4|5[1-5]|2[2-7]|3[47]|6(?:011|5)"
CUES = {
    "email": "mail|contact|write to|reach|correo|courriel|adresse",
    "ip": "ip|host|server|address|from",
    "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|cell|telefon|appel|llame",
}
AGAINST = "version|isbn|order|invoice|serial|ref|page|section|figure|item|id"
CONTEXT_CHARS = 40
# Every match has two characters or more, so that many pieces hold the context.
CONTEXT_PIECES = CONTEXT_CHARS // 2
# Pieces whose places are summed one after the other.
BLOCK_PIECES = 32
SPANS = "array<struct<start: int, end: int, value: string, before: string>>"
WITH_AFTER = SPANS.replace(">>", ", after: string>>")


@dataclass(frozen=True)
class Settings:
    em_rounds: int = 30
    prior: float = 0.5
    #: Probability from which a candidate is added.
    threshold: float = 0.9


def _length(c: Column) -> Column:
    return F.char_length(c)


def found_spans(text: Column, pattern: str, needs: str | None = None) -> Column:
    """Array of (start, end, value, before, after) of all matches: gaps and matches alternate.

    ``before`` has the CONTEXT_CHARS characters before a match and ``after`` the one behind it. The text itself is cut once,
    at all matches; contexts come from the pieces nearby. Ends of blocks of pieces are summed first, so that places within
    a block are summed from its start only.
    """
    none = F.array().cast(SPANS)
    empty = F.array().cast(WITH_AFTER)
    cut = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"))

    def pieces(c: Column) -> Column:
        """The last piece is what follows the last match."""
        return F.transform(
            F.arrays_zip(c["gaps"].alias("g"), c["values"].alias("v")),
            lambda x: F.struct(
                _length(x["g"]).alias("gap"),
                F.coalesce(_length(x["v"]), F.lit(0)).alias("size"),
                x["v"].alias("value"),
                F.right(x["g"], F.lit(CONTEXT_CHARS)).alias("tail"),
                F.left(F.concat(F.left(x["g"], F.lit(1)), F.coalesce(x["v"], F.lit(""))), F.lit(1)).alias("head"),
            ),
        )

    def in_block(b: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            at = acc["at"] + x["gap"]
            end = (at + x["size"]).cast("int")
            before = F.right(F.concat(acc["before"], x["tail"]), F.lit(CONTEXT_CHARS))
            span = F.struct(at.cast("int").alias("start"), end.alias("end"), x["value"].alias("value"), before.alias("before"))
            behind = F.right(F.concat(before, x["value"]), F.lit(CONTEXT_CHARS))
            return F.struct(end.alias("at"), behind.alias("before"), F.concat(acc["spans"], F.array(span)).alias("spans"))

        start = F.struct(b["start"].cast("int").alias("at"), b["before"].alias("before"), none.alias("spans"))
        return F.aggregate(b["block"], start, step, lambda acc: acc["spans"])

    def placed(every: Column) -> Column:
        n = F.size(every) - 1
        blocks = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(BLOCK_PIECES)), lambda i: _block(every, i, n))
        spans = F.flatten(F.transform(_with_starts(blocks), in_block))
        return F.transform(spans, lambda s, i: s.withField("after", F.get(every, i + 1)["head"]))

    spans = _once(_once(cut, pieces), placed)
    has = F.regexp_like(text, F.lit(pattern)) if needs is None else F.contains(text, F.lit(needs))
    return F.when(has, spans).otherwise(empty)


def _block(every: Column, first: Column, n: Column) -> Column:
    """Up to BLOCK_PIECES pieces with a match from a place on, their length, and the characters before them."""
    block = F.slice(every, first + 1, F.least(n - first, F.lit(BLOCK_PIECES)))
    length = F.aggregate(block, F.lit(0), lambda a, x: a + x["gap"] + x["size"])
    back = F.least(first, F.lit(CONTEXT_PIECES))
    near = F.transform(F.slice(every, first - back + 1, back), lambda x: F.concat(x["tail"], x["value"]))
    before = F.right(F.array_join(near, ""), F.lit(CONTEXT_CHARS))
    return F.struct(block.alias("block"), length.alias("length"), before.alias("before"))


def _once(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _with_starts(blocks: Column) -> Column:
    """Blocks with the length of all before them."""

    def start(lengths: Column, i: Column) -> Column:
        return F.aggregate(F.slice(lengths, F.lit(1), i), F.lit(0), lambda a, x: a + x)

    def placed(blocks: Column, lengths: Column) -> Column:
        return F.transform(blocks, lambda b, i: F.struct(b["block"].alias("block"), b["before"].alias("before"), start(lengths, i).alias("start")))

    return _once(blocks, lambda found: _once(F.transform(found, lambda b: b["length"]), lambda lengths: placed(found, lengths)))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    signs = F.split(F.reverse(digits), "")
    doubled = F.transform(
        signs,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.regexp_like(value, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    digits = digits_of(value)
    if kind == "card":
        return F.length(digits).between(13, 19) & F.when(F.length(digits).between(13, 19), passes_luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15)


def scan(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, base, cands): the base spans of each kind and the candidates with their context."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = df.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    names = {k: f"m_{k}" for k in KINDS} | {f"{k}_loose": f"m_{k}_loose" for k in LOOSE}
    patterns = BASE | {f"{k}_loose": p for k, p in LOOSE.items()}
    needs = NEEDS | {"email_loose": None}
    spans = source.select("doc_id", "text", *[found_spans(F.col("text"), patterns[k], needs.get(k)).alias(c) for k, c in names.items()])

    def candidates(key: str) -> Column:
        kind, loose = key.split("_")[0], key.endswith("_loose")

        def one(s: Column) -> Column:
            ok = F.lit(False) if loose else passes(kind, s["value"])
            return F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
                ok.alias("ok"), F.lit(loose).alias("loose"), F.lower(s["before"]).alias("before"), s["after"].alias("after"),
            )

        return F.transform(F.col(names[key]), one)

    cands = spans.select("doc_id", F.concat(*[candidates(k) for k in names]).alias("cands"))
    return cands.select("doc_id", F.transform("cands", _judged).alias("cands"))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, 0).otherwise(-1)


def _judged(c: Column) -> Column:
    """A candidate with its votes and features in place of its text."""
    kind, value = c["kind"], F.lower(c["value"])
    digits = digits_of(c["value"])

    def by_kind(patterns: dict[str, Column]) -> Column:
        out = F.lit(False)
        for k, p in patterns.items():
            out = F.when(kind == k, p).otherwise(out)
        return out

    listed = by_kind(
        {
            "email": F.regexp_like(value, F.lit(rf"(?:\.|dot[\])] ?)(?:{DOMAINS})$")),
            "ip": ~F.regexp_like(value, F.lit(r"^0+\.")),
            "card": F.regexp_like(digits, F.lit(rf"^(?:{ISSUER})")),
            "phone": F.regexp_like(value, F.lit(rf"^\+(?:{COUNTRY})")) | F.regexp_like(value, F.lit(r"^\(?[2-9][0-9]{2}")),
        }
    )
    cue = by_kind({k: F.regexp_like(c["before"], F.lit(rf"\b(?:{words})")) for k, words in CUES.items()})
    against = F.regexp_like(c["before"], F.lit(rf"\b(?:{AGAINST})[ .:#]*$"))
    joined = F.regexp_like(F.right(c["before"], F.lit(1)), F.lit(r"[0-9a-z_./-]")) | F.regexp_like(c["after"], F.lit(r"[0-9A-Za-z_/@-]"))
    flat = F.regexp_like(digits, F.lit(r"^([0-9])\1*$")) & (kind != "email")
    shaped = by_kind(
        {
            "email": F.length(value).between(6, 80),
            "ip": F.regexp_like(value, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$")),
            "card": F.length(digits).between(13, 19),
            "phone": F.length(digits).between(9, 15),
        }
    )
    votes = F.array(
        _vote(c["ok"], ~c["ok"] & ~c["loose"]), _vote(listed, ~listed), _vote(cue, against), _vote(F.lit(False), joined), _vote(shaped & ~flat, ~shaped | flat)
    )
    features = F.array(
        F.concat(F.lit("check:"), F.when(c["loose"], "none").when(c["ok"], "passed").otherwise("failed")),
        F.concat(F.lit("listed:"), listed.cast("string")),
        F.concat(F.lit("cue:"), cue.cast("string"), against.cast("string")),
        F.concat(F.lit("joined:"), joined.cast("string")),
        F.concat(F.lit("digits:"), F.least(F.length(digits), F.lit(20)).cast("string")),
        F.concat(F.lit("signs:"), F.regexp_like(value, F.lit("[ ().-]")).cast("string"), flat.cast("string")),
    )
    return F.struct(kind.alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["ok"].alias("ok"), votes.alias("votes"), features.alias("features"))


def estimate(patterns: list[tuple[tuple[int, ...], int]], settings: Settings) -> dict[tuple[int, ...], float]:
    """Probability of each combination of votes, by expectation-maximisation over the counted combinations.

    A labeler has a rate of yes votes among true and among false candidates; not voting says nothing. Rates are smoothed,
    and start from labelers being right more often than not.
    """
    if not patterns:
        return {}
    width = len(patterns[0][0])
    share, true, false = settings.prior, [0.8] * width, [0.2] * width
    total = sum(n for _, n in patterns)
    odds: dict[tuple[int, ...], float] = {}
    for _ in range(settings.em_rounds):
        for votes, _ in patterns:
            log = math.log(share / (1 - share))
            for v, t, f in zip(votes, true, false):
                if v >= 0:
                    log += math.log(t / f) if v else math.log((1 - t) / (1 - f))
            odds[votes] = 1 / (1 + math.exp(-max(-500.0, min(500.0, log))))
        share = min(0.99, max(0.01, sum(odds[v] * n for v, n in patterns) / total))
        for k in range(width):
            cast = [(odds[v], v[k], n) for v, n in patterns if v[k] >= 0]
            true[k] = (1.6 + sum(p * n * v for p, v, n in cast)) / (2 + sum(p * n for p, _, n in cast))
            false[k] = (0.4 + sum((1 - p) * n * v for p, v, n in cast)) / (2 + sum((1 - p) * n for p, _, n in cast))
            true[k], false[k] = (min(0.999, max(0.001, x)) for x in (true[k], false[k]))
    return odds


def train(cands: DataFrame, settings: Settings) -> tuple[dict[str, float], dict[tuple[str, str], float]]:
    """Log odds of each kind, and of each (kind, feature value). ``cands``: (kind, votes, features)."""
    combos: dict[str, list] = {}
    for r in cands.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect():  # at most 4 * 3^5 rows
        combos.setdefault(r["kind"], []).append((tuple(r["votes"]), r["n"]))
    soft = {(k, v): p for k, rows in combos.items() for v, p in estimate(sorted(rows), settings).items()}
    bias, weights = {}, {}
    counts = cands.select("kind", "votes", F.explode("features").alias("feature")).groupBy("kind", "votes", "feature").agg(F.count("*").alias("n")).collect()  # fixed values
    sums: dict[tuple, list[float]] = {}
    for r in counts:
        p = soft[r["kind"], tuple(r["votes"])]
        cell = sums.setdefault((r["kind"], r["feature"]), [0.0, 0.0])
        cell[0] += p * r["n"]
        cell[1] += (1 - p) * r["n"]
    for kind, rows in combos.items():
        yes, no = (1 + sum(q * n for q, n in ((soft[kind, v] if s else 1 - soft[kind, v], n) for v, n in rows)) for s in (1, 0))
        bias[kind] = math.log(yes / no)
        for (k, feature), (a, b) in sums.items():
            if k == kind:
                weights[kind, feature] = math.log((a + 0.5) / (yes + 1)) - math.log((b + 0.5) / (no + 1))
    return bias, weights


def _numbers(values: dict[str, float]) -> Column:
    if not values:
        return F.create_map().cast("map<string, double>")
    return F.create_map(*[F.lit(x) for pair in sorted(values.items()) for x in pair])


def find_spans(df: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added): arrays of (rank of the kind, kind, start, end), sorted."""
    found = materialize(scan(df, id_col, text_col))
    flat = found.select(F.explode("cands").alias("c")).select("c.kind", "c.votes", "c.features")
    bias, weights = train(flat, settings)
    bias_of, weight_of = _numbers(bias), _numbers({f"{k}|{f}": w for (k, f), w in weights.items()})
    cut = math.log(settings.threshold / (1 - settings.threshold))

    def log_odds(c: Column) -> Column:
        own = F.transform(c["features"], lambda f: F.coalesce(weight_of[F.concat(c["kind"], F.lit("|"), f)], F.lit(0.0)))
        return F.aggregate(own, F.coalesce(bias_of[c["kind"]], F.lit(-9.0)), lambda a, x: a + x)

    def plain(c: Column) -> Column:
        rank = F.array_position(F.array(*map(F.lit, KINDS)), c["kind"]).cast("int")
        return F.struct(rank.alias("rank"), c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))

    base = found.select("doc_id", F.filter("cands", lambda c: c["ok"]).alias("base"), F.filter("cands", lambda c: ~c["ok"]).alias("rest"))
    apart = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    added = F.filter("rest", lambda c: (log_odds(c) >= cut) & apart(c))
    return base.select("doc_id", F.array_sort(F.transform("base", plain)).alias("base"), F.array_sort(F.transform(added, plain)).alias("added"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
