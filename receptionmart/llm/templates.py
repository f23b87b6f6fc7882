"""Benchmark passages in texts, also with other numbers, names and units.

Texts and benchmark items become token sequences in which numbers, names and units are typed placeholders, while their
values are kept as slots. Every window of ``window`` tokens is hashed twice: as its words in lower case (literal), which
neither case nor punctuation changes, and, if it has slots, with placeholders (template). A bitmap of a fixed size of all
item windows goes to every task, so that only windows with a set bit leave the scan; the join on the whole hash settles
them. Matches of a row and an item at one alignment are then taken together: they must cover ``least_words`` words of the
item, or all of a shorter one. Literal matches always count. Template matches count unless they hold a value of the item
that stands for two values in the text; two values of the item may become one. They need a ``seed`` among the matches of
the alignment: a literal window, or one with ``plain_share`` of plain words; in items without such windows those with the
most plain words are seeds. Templates without any plain word are numbers or names only and match literally only.

Defined cases: null and empty texts match nothing; items shorter than a window are windows of their own, those of fewer than
``least_item`` tokens as literal words only; each row is a text of its own, whatever its id; a text that holds an item
several times, or several rows with one id (a null id is an id of its own), are one hit; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, text_batches

UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles g kg mg lb lbs pound pounds oz ounce ounces l ml liter "
    "liters litre litres s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "percent dollar dollars euro euros cent cents degree degrees mph kmh".split()
)
NUMBER_WORDS = frozenset("two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
NUMBER = re.compile(r"[+-]?[$€£]?[0-9][0-9.,/:]*%?$")
QUANTITY = re.compile(r"([+-]?[0-9][0-9.,]*)([A-Za-zµ°]{1,4})$")
STOPS = frozenset(".!?:")
MARKS = ".,;:!?()[]{}\"'«»“”„…*"
WORD, NUM, UNIT, NAME, QUANT, BREAK, SKIP = range(7)
PLAIN_KIND = {w: UNIT for w in UNITS} | {w: NUM for w in NUMBER_WORDS}
#: Stands for the end of a line among tokens; noncharacters that no text should hold.
LINE_END = "\ufffe\uffff"
CACHED_TOKENS = 150_000


@dataclass(frozen=True)
class Rule:
    window: int = 8
    plain_share: float = 0.6
    least_words: int = 13
    least_item: int = 5
    filter_bits: int = 1 << 24


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text)


#: Hash of the placeholder of each kind; plain words and what is left out have none.
PLACE_OF = np.array([0, *map(_hash, ("<number>", "<unit>", "<name>", "<quantity>")), 0, 0], np.uint64)


def kind_of(token: str) -> tuple[int, int, int, str]:
    """(kind, hash as a word, whether it ends a sentence, value). A capitalised word is NAME, unless it opens a sentence."""
    if token == LINE_END:
        return BREAK, 0, 1, ""
    core = token.strip(MARKS)
    if core.isalpha() and core.islower() and token[-1] not in "\"')»”":
        return PLAIN_KIND.get(core, WORD), _hash(core), int(token[-1] in STOPS), core
    last = token[-1]
    ends = int(last in STOPS or last in "\"')»”" and token.rstrip("\"')»”")[-1:] in STOPS and core != token)
    if not core:
        return SKIP, 0, ends, ""
    low = core.lower()
    if not core.isalpha():
        if NUMBER.match(core):
            return NUM, _hash(low), ends, low
        found = QUANTITY.match(core)
        if found and found[2].lower() in UNITS:
            return QUANT, _hash(low), ends, low
    if low in NUMBER_WORDS:
        return NUM, _hash(low), ends, low
    if low in UNITS:
        return UNIT, _hash(low), ends, low
    return (NAME if core[0].isupper() and core != core.upper() else WORD), _hash(low), ends, low


class Reader:
    """Turns texts into arrays of kinds, hashes and values. Tokens met before are looked up."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.values: list[str] = []
        self.kinds, self.ends = np.zeros(1 << 17, np.int8), np.zeros(1 << 17, bool)
        self.hashes = np.zeros(1 << 17, np.uint64)

    def learn(self, tokens: set[str]) -> None:
        # What ``kind_of`` says of most tokens needs no look at signs, digits or capitals.
        plain = [t for t in tokens if t.isalpha() and t.islower()]
        others = list(tokens.difference(plain))
        first, last = len(self.values), len(self.values) + len(tokens)
        while last > len(self.kinds):
            self.kinds, self.ends, self.hashes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.kinds, self.ends, self.hashes))
        self.numbers.update(zip(plain + others, range(first, last)))
        self.values += plain
        middle = len(self.values)
        self.hashes[first:middle] = np.fromiter(map(_hash, plain), np.uint64, len(plain))
        for token in PLAIN_KIND.keys() & plain:
            self.kinds[self.numbers[token]] = PLAIN_KIND[token]
        if others:
            self.kinds[middle:last], self.hashes[middle:last], self.ends[middle:last], values = map(list, zip(*map(kind_of, others)))
            self.values += values

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word hashes, kinds, token numbers) of the tokens of a text."""
        if len(self.values) > CACHED_TOKENS:
            self.forget()
        tokens = text.replace("\n", f" {LINE_END} ").split()
        fresh = set(tokens).difference(self.numbers)
        if fresh:
            self.learn(fresh)
        at = np.fromiter(map(self.numbers.__getitem__, tokens), np.int64, len(tokens))
        kind = self.kinds[at]
        kept = np.flatnonzero((kind != BREAK) & (kind != SKIP))
        # A word opens a sentence if one has ended since the word before it; the first one opens the text.
        ended = 1 + np.r_[0, np.cumsum(self.ends[at])][kept]
        opened = np.diff(ended, prepend=0) > 0
        at, kind = at[kept], kind[kept]
        kind[(kind == NAME) & opened] = WORD
        unit = np.flatnonzero(kind == UNIT)
        kind[unit[(unit == 0) | (kind[unit - 1] != NUM)]] = WORD
        return self.hashes[at], kind, at

    def slots(self, kind: np.ndarray, at: np.ndarray, start: int, width: int) -> list[str]:
        return [self.values[at[i]] for i in range(start, start + width) if kind[i] != WORD]


class Roller:
    """Hashes of all windows of a sequence, by differences of running sums."""

    BASE, INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def sums(self, hashed: np.ndarray) -> np.ndarray:
        while len(self.up) < len(hashed):
            n = len(self.up)
            for name, base in (("up", self.BASE), ("down", self.INVERSE)):
                powers = getattr(self, name)
                setattr(self, name, np.concatenate([powers, powers * np.uint64(pow(base, n, 1 << 64))]))
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed * self.down[: len(hashed)])])

    def windows(self, sums: np.ndarray, width: int, start: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the windows at ``start``, or of all."""
        n = len(sums) - width
        if start is None:
            total = (sums[width:] - sums[:n]) * self.up[:n]
        else:
            total = (sums[start + width] - sums[start]) * self.up[start]
        total = (total ^ (total >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(width)
        return total ^ (total >> np.uint64(32))


def with_places(words: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Hashes with placeholders for the slots."""
    return np.where(kind == WORD, words, PLACE_OF[kind])


def windows_of(roller: Roller, words: np.ndarray, places: np.ndarray, plain: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, whether literal, plain words) of all windows, and again of those with slots and plain words.

    ``words`` and ``places`` are running sums of the hashes, ``plain`` those of the plain words.
    """
    n = len(words) - width
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
    plain = plain[width:] - plain[:n]
    start = np.flatnonzero((plain > 0) & (plain < width))
    hashes = np.r_[roller.windows(words, width), roller.windows(places, width, start)]
    return hashes, np.r_[np.arange(n), start], np.arange(n + len(start)) < n, np.r_[plain, plain[start]]


WINDOWS = "id bigint, row binary, hash bigint, place int, width int, tokens int, literal boolean, seed boolean, slots array<string>"


def _windows(rule: Rule, widths: list[int] | None, bitmap):
    """Function of mapInArrow; ``widths`` None: each text has its own (items). ``row`` tells texts apart, by content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, roller = Reader(), Roller()
        bits = bitmap.value if bitmap is not None else None
        for batch, texts in text_batches(batches):
            rows: list[tuple] = []
            for id_, text in zip(batch.column("id").to_pylist(), texts):
                words, kind, at = reader.read(text)
                if not len(words):
                    continue
                row = None
                sums = roller.sums(words), roller.sums(with_places(words, kind)), np.r_[0, np.cumsum(kind == WORD)]
                for width in widths or [min(rule.window, len(words))]:
                    found, start, literal, plain = windows_of(roller, *sums, width)
                    if widths is None and len(words) < rule.least_item:
                        found, start, literal, plain = found[literal], start[literal], literal[literal], plain[literal]
                    seed = literal | (plain >= rule.plain_share * width)
                    if bits is None:
                        thin = plain[~literal]
                        if len(thin) and not (plain >= rule.plain_share * width).any():
                            seed |= plain == thin.max()
                    else:
                        place = (found % np.uint64(rule.filter_bits)).astype(np.int64)
                        hit = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
                        found, start, literal, seed = found[hit], start[hit], literal[hit], seed[hit]
                    if row is None and len(found):
                        row = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
                    for h, s, own, first in zip(found.view(np.int64).tolist(), start.tolist(), literal.tolist(), seed.tolist()):
                        slots = None if own and bits is not None else reader.slots(kind, at, s, width)
                        rows.append((id_, row, h, s, width, len(words), own, first, slots))
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.bool_(), pa.list_(pa.string())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [p.split()[0] for p in WINDOWS.split(", ")])

    return run


def find_leaks(
    df: DataFrame,
    items: DataFrame,
    rule: Rule = Rule(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, verbatim), one row for each text and item that match."""
    spark = df.sparkSession
    bounded_batches(spark)
    source = items.select(F.col(item_id_col).cast("bigint").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    wanted = materialize(source.mapInArrow(_windows(rule, None, None), WINDOWS))
    widths = sorted(r["width"] for r in wanted.select("width").distinct().collect())  # at most ``window`` values
    bits = np.zeros(rule.filter_bits // 8, np.uint8)
    places = wanted.select(F.expr(f"cast(pmod(hash, {rule.filter_bits}) as int)").alias("p")).distinct()
    at = places.toArrow()["p"].to_numpy()  # at most ``filter_bits`` numbers
    np.bitwise_or.at(bits, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
    bitmap = spark.sparkContext.broadcast(bits)
    texts = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = texts.mapInArrow(_windows(rule, widths or [rule.window], bitmap), WINDOWS)
    item_slots = F.col("w.slots")
    pairs = found.alias("d").join(wanted.alias("w"), ["hash", "width", "literal"]).select(
        F.col("d.id").alias("doc_id"),
        F.col("d.row").alias("row"),
        F.col("w.id").alias("item_id"),
        F.col("w.row").alias("item_row"),
        (F.col("d.place") - F.col("w.place")).alias("shift"),
        F.col("w.place").alias("place"),
        "width",
        "literal",
        F.col("w.seed").alias("seed"),
        F.col("w.tokens").alias("tokens"),
        F.arrays_zip(item_slots.alias("item"), F.when(F.col("literal"), item_slots).otherwise(F.col("d.slots")).alias("doc")).alias("slots"),
    )
    # A row and an item at one alignment have at most twice as many windows as the item.
    taken = pairs.groupBy("doc_id", "row", "item_id", "item_row", "shift", "width", "tokens").agg(
        F.collect_set(F.struct("place", "literal", "slots")).alias("found"), F.max("seed").alias("seeded")
    )
    values = F.array_distinct(F.flatten("found.slots"))  # an item's value twice: it stands for several values
    several = F.array_distinct(F.filter("sides", lambda v, i: F.array_position("sides", v) <= i))
    counted = F.filter("found", lambda w: w["literal"] | (F.col("seeded") & ~F.arrays_overlap(w["slots"]["item"], F.col("several"))))
    gaps = F.transform("places", lambda p, i: F.when(i == 0, F.col("width")).otherwise(F.least(F.col("width"), p - F.element_at("places", i))))
    words = F.aggregate(gaps, F.lit(0), lambda a, x: a + x)
    return (
        taken.withColumn("values", values)
        .withColumn("sides", F.col("values.item"))
        .withColumn("several", several)
        .withColumn("counted", counted)
        .withColumn("places", F.array_sort(F.array_distinct("counted.place")))
        .withColumn("slots", F.flatten("counted.slots"))
        .withColumn("words", words)
        .filter(F.col("words") >= F.least(F.lit(rule.least_words), F.col("tokens")))
        .groupBy("doc_id", "item_id")
        .agg(
            F.max(
                F.struct(
                    F.col("words"),
                    F.forall("slots", lambda s: s["item"] == s["doc"]).alias("verbatim"),
                    (-(F.col("shift") + F.element_at("places", 1))).alias("start"),
                )
            ).alias("best")
        )
        .select("doc_id", "item_id", (-F.col("best.start")).cast("bigint").alias("start_word"), F.col("best.words").cast("bigint").alias("n_words"), "best.verbatim")
    )
