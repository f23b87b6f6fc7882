"""Phrase collocations by dynamic itemset counting.

Texts are numbered once, word by word, in chunks that are dealt into shards. Shards are scanned in turn, round and round. The
first round counts words. A longer phrase is tallied from the scan after that in which both its subphrases (without its last
and without its first word) have been reached, in whatever scan that is, so several lengths are counted in one scan. A phrase
is done with after one full round from its own start. The scans end when no phrase is open.

A scan tallies the open phrases of its shard by hash: a chunk gives one row of hashes and counts for each range of hashes, and
ranges are summed apart from each other. A phrase that reaches the threshold in a round has a shard with its share of the
threshold, so a hash counts as reached once a shard has that share of it. Which hashes have been reached, and whether lately,
goes to the tasks as two bit maps of a fixed size. Hashes are shortened to 32 bits within a range. Shares, equal hashes and false bits only open phrases that need not be;
when the scans have ended, phrases with a bit are counted in all chunks, by word numbers within a chunk and by the phrase
itself, packed by range, over chunks, and those below the threshold go. So all counts are exact.

Defined cases: a null text is empty, a null language is ``und``; each row is a text of its own, so repeated rows count as
often as they come; phrases don't cross pieces or texts; a text of any length is counted whole, in parts that overlap by a
phrase. Languages without candidates, and empty tables, give no row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shuffles_removed
from .common import BROADCAST_ROWS, bounded_batches, materialize, small_enough
from .warc import new_folder

#: Ends of pieces become full stops, tabs and spaces separate words, other characters belong to words.
ENDS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(ENDS + b"\t" + bytes(range(65, 91)), b"." * len(ENDS) + b" " + bytes(range(97, 123)))
KEYS = ["lang", "size", "phrase"]
COUNTS, PACKED = "lang string, size int, phrase string, a bigint", "part int, lang string, phrases binary, counts binary"
REACHED, TALLY = "key bigint", "part int, keys binary, counts binary"
CHUNK = "lang string, n int, listed array<string>, hashes binary, words binary, over int, shard int"
#: A chunk is megabytes, a range of its hashes kilobytes, so what goes to Python at a time is bounded by bytes.
BATCH_BYTES = 4 * 2**20
#: Counted phrases of chunks that a task brings together before it sends them.
PACKED_ROWS = 500_000
#: Phrases that may be broadcast; more are joined by a shuffle.
FEW = BROADCAST_ROWS // 2


@dataclass(frozen=True)
class Rule:
    least_count: int = 100
    longest: int = 5
    #: A candidate goes if a longer one that holds it has this share of its count.
    contained_percent: int = 100
    top: int = 2000
    shards: int = 4
    #: Bits of each map; both go to every task.
    map_bits: int = 1 << 24
    #: Words of a chunk, which is counted at a time.
    words_held: int = 1_000_000
    #: Words of the table for each range of hashes, and the fewest ranges; a power of two of them is taken.
    part_words: int = 4_000_000
    least_parts: int = 64


class Numbers(dict):
    """Words of one language to numbers in the order in which they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def words_of(text: str) -> list[bytes]:
    """Words of a text and, between pieces, full stops."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).replace(b".", b" . ").split()


def _mixed(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word and that of the last."""
    out = (head ^ (head >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + word
    return out ^ (out >> np.uint64(29))


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def _keys(hashes: np.ndarray, shift: int, is_longest: bool) -> np.ndarray:
    """Shortened hashes; the last bit tells whether their phrases are of the greatest length, which opens no others."""
    return (hashes >> np.uint64(shift)) << np.uint64(1) | np.uint64(is_longest)


@dataclass(frozen=True)
class Maps:
    """Bits of the shortened hashes that have been reached, and of those that have been lately."""

    reached: np.ndarray
    late: np.ndarray
    shift: int

    def has(self, bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        at = ((hashes >> np.uint64(self.shift)) & np.uint64(8 * len(bits) - 1)).astype(np.int64)
        return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


class Held:
    """Words of one language that are numbered together; -1 stands between pieces, other numbers count from 1."""

    def __init__(self):
        self.numbers = Numbers({b".": -1})
        self.parts: list[np.ndarray] = []
        self.size = 0

    def take(self, words: list[bytes]) -> None:
        self.parts += [np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)), np.array([-1], np.int32)]
        self.size += len(words) + 1

    def row(self, lang: str, over: int, shard: int) -> pa.RecordBatch:
        listed, words = list(self.numbers), np.concatenate(self.parts)
        columns = [
            pa.array([lang], pa.string()),
            pa.array([np.count_nonzero(words[: len(words) - over] > 0)], pa.int32()),
            pa.array([[w.decode("utf-8", "surrogatepass") for w in listed]], pa.list_(pa.string())),
            pa.array([_word_hashes(lang, listed).tobytes()], pa.binary()),
            pa.array([words.tobytes()], pa.binary()),
            pa.array([over], pa.int32()),
            pa.array([shard], pa.int32()),
        ]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in CHUNK.split(", ")])


def _numbered(texts: DataFrame, rule: Rule) -> DataFrame:
    """Chunks of about ``words_held`` words as numbers, dealt to shards in turn.

    A longer text is cut; the words of the next chunk that phrases over the cut need stand at the end too (``over``).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        held: dict[str, Held] = {}
        chunk = context.partitionId() if context else 0
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                for start in range(0, len(words) - rule.words_held, rule.words_held):
                    part = Held()
                    end = start + rule.words_held
                    part.take(words[start : end + rule.longest - 1])
                    yield part.row(lang, part.size - rule.words_held, chunk % rule.shards)
                    chunk += 1
                held.setdefault(lang, Held()).take(words[max(0, -(-len(words) // rule.words_held) - 1) * rule.words_held :])
                if sum(x.size for x in held.values()) >= rule.words_held:
                    yield from (own.row(key, 0, chunk % rule.shards) for key, own in held.items())
                    held.clear()
                    chunk += 1
        yield from (own.row(key, 0, chunk % rule.shards) for key, own in held.items())

    return texts.mapInArrow(run, CHUNK)


def _phrases(hashes: np.ndarray, words: np.ndarray, limit: int, maps: Maps, longest: int, is_open: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, starts, hashes) of phrases of two words and more that begin before ``limit``.

    Either of the open ones, whose subphrases have both been reached, one of them lately, or of those reached themselves.
    """
    usable, fresh = maps.has(maps.reached, hashes), maps.has(maps.late, hashes)
    usable[0] = False
    # Starts of phrases of the length at hand that have been reached, with their hashes and whether lately.
    start = np.flatnonzero(usable[words] & (words > 0))
    head, new = hashes[words[start]], fresh[words[start]]
    for size in range(2, longest + 1):
        # Both subphrases: this one, and the one that starts a word later.
        follows = np.flatnonzero(start[1:] == start[:-1] + 1)
        if not len(follows):
            return
        begin = start[follows]
        total = _mixed(head[follows], hashes[words[begin + size - 1]])
        if is_open:
            own = (new[follows] | new[follows + 1]) & (begin < limit)
            yield size, begin[own], total[own]
            if size == longest:
                return
        kept = maps.has(maps.reached, total)
        start, head = begin[kept], total[kept]
        new = maps.has(maps.late, head)
        if not is_open:
            yield size, start[start < limit], head[start < limit]


def _tallies(hashes: np.ndarray, words: np.ndarray, limit: int, with_words: bool, maps: Maps | None, rule: Rule, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys in order, counts) of the words, if asked for, and of the open phrases that begin before ``limit``."""
    if with_words:
        own = words[:limit]
        n = np.bincount(own[own > 0], minlength=len(hashes))
        at = np.flatnonzero(n)
        keys = _keys(hashes[at], shift, rule.longest == 1)
        order = np.argsort(keys)
        yield keys[order], n[at][order]
    if maps is not None:
        found = [_keys(total, shift, size == rule.longest) for size, _, total in _phrases(hashes, words, limit, maps, rule.longest, True)]
        if found:
            yield np.unique(np.concatenate(found), return_counts=True)


def _counts(lang: str, text: pa.Array, hashes: np.ndarray, words: np.ndarray, limit: int, maps: Maps, longest: int) -> Iterator[pa.RecordBatch]:
    """Rows of (part, lang, phrase, n) of the words and phrases with a bit that begin before ``limit``."""
    own = words[:limit]
    n = np.bincount(own[own > 0], minlength=len(hashes))
    at = np.flatnonzero((n > 0) & maps.has(maps.reached, hashes))
    yield _rows(lang, hashes[at], text.take(pa.array(at)), n[at], maps.shift)
    for size, at, total in _phrases(hashes, words, limit, maps, longest, False):
        key = words[at].astype(np.int64)
        for k in range(1, size):
            if k > 1:
                key = np.unique(key, return_inverse=True)[1]
            key = key * len(text) + words[at + k]
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        columns = [text.take(pa.array(words[at[first] + k])) for k in range(size)]
        yield _rows(lang, total[first], pc.binary_join_element_wise(*columns, " "), counts, maps.shift)


def _rows(lang: str, hashes: np.ndarray, phrases: pa.Array, counts: np.ndarray, shift: int) -> pa.RecordBatch:
    part = (hashes >> np.uint64(shift) >> np.uint64(31)).astype(np.int32)
    columns = [pa.array(part), pa.repeat(pa.scalar(lang, pa.string()), len(phrases)), phrases, pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["part", "lang", "phrase", "n"])


def _packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row for each range and language, of phrases in order, which compress well. No word holds a line feed."""
    order = [("part", "ascending"), ("lang", "ascending"), ("phrase", "ascending")]
    rows = pa.Table.from_batches(held).group_by(["part", "lang", "phrase"]).aggregate([("n", "sum")]).sort_by(order)
    part, lang, phrases = rows["part"].to_numpy(), rows["lang"].to_numpy(), rows["phrase"].to_pylist()
    counts = rows["n_sum"].to_numpy()
    edges = [0, *(np.flatnonzero((part[1:] != part[:-1]) | (lang[1:] != lang[:-1])) + 1).tolist(), len(part)]
    columns = [
        pa.array(part[edges[:-1]], pa.int32()),
        pa.array(lang[edges[:-1]], pa.string()),
        pa.array([zlib.compress("\n".join(phrases[a:b]).encode(), 1) for a, b in zip(edges, edges[1:])], pa.binary()),
        pa.array([zlib.compress(counts[a:b].astype(np.int64).tobytes(), 1) for a, b in zip(edges, edges[1:])], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "lang", "phrases", "counts"])


def _maps_of(maps, shift: int) -> Maps | None:
    return Maps(*(np.frombuffer(m, np.uint8) for m in maps.value), shift) if maps is not None else None


def _shift(parts: int) -> int:
    """Bits that hashes are shortened by: what is left tells the range and, with the last bit of a key, 32 bits within it."""
    return 64 - 31 - (parts.bit_length() - 1)


def _scan(chunks: DataFrame, rule: Rule, parts: int, with_words: bool, maps) -> DataFrame:
    """Tallies of the open phrases of chunks: keys and counts of a chunk for each of ``parts`` ranges, a power of two."""
    shift, least = _shift(parts), np.arange(parts, dtype=np.uint64) << np.uint64(32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _maps_of(maps, shift)
        for batch in batches:
            for i in range(batch.num_rows):
                hashes, words, over = (batch.column(c)[i].as_py() for c in ("hashes", "words", "over"))
                words = np.frombuffer(words, np.int32)
                for keys, counts in _tallies(np.frombuffer(hashes, np.uint64), words, len(words) - over, with_words, bits, rule, shift):
                    edges = [*np.searchsorted(keys, least).tolist(), len(keys)]
                    filled = [p for p in range(parts) if edges[p] < edges[p + 1]]
                    columns = ([x[edges[p] : edges[p + 1]].tobytes() for p in filled] for x in (keys.astype(np.uint32), counts.astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), *(pa.array(x, pa.binary()) for x in columns)], ["part", "keys", "counts"])

    return chunks.select("hashes", "words", "over").mapInArrow(run, TALLY)


def _with_share(tallies: DataFrame, share: int) -> DataFrame:
    """Keys that are found ``share`` times, summed range by range."""

    def run(own: pa.Table) -> pa.Table:
        keys, counts = (np.frombuffer(b"".join(own.column(c).to_pylist()), t) for c, t in (("keys", np.uint32), ("counts", np.int32)))
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        enough = np.add.reduceat(counts[order], first, dtype=np.int64) >= share
        return pa.table({"key": pa.array((own.column("part")[0].as_py() << 32) + keys[first[enough]].astype(np.int64), pa.int64())})

    return tallies.groupBy("part").applyInArrow(run, REACHED)


def _counted(chunks: DataFrame, rule: Rule, parts: int, maps) -> DataFrame:
    """Counts of the phrases with a bit, packed by range and language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = _maps_of(maps, _shift(parts))
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for i in range(batch.num_rows):
                lang, hashes, words, over = (batch.column(c)[i].as_py() for c in ("lang", "hashes", "words", "over"))
                words = np.frombuffer(words, np.int32)
                text = batch.column("listed")[i].values
                held += [r for r in _counts(lang, text, np.frombuffer(hashes, np.uint64), words, len(words) - over, bits, rule.longest) if r.num_rows]
                if sum(r.num_rows for r in held) >= PACKED_ROWS:
                    yield _packed(held)
                    held.clear()
        if held:
            yield _packed(held)

    return chunks.mapInArrow(run, PACKED)


def _frequent(packed: DataFrame, rule: Rule) -> DataFrame:
    """(lang, size, phrase, a) of all phrases with ``least_count`` occurrences, summed range by range."""

    def run(own: pa.Table) -> pa.Table:
        tables = []
        for lang, phrases, counts in zip(*(own.column(c) for c in ("lang", "phrases", "counts"))):
            listed = pa.array(zlib.decompress(phrases.as_py()).decode().split("\n"), pa.string())
            n = np.frombuffer(zlib.decompress(counts.as_py()), np.int64)
            tables.append(pa.table({"lang": pa.repeat(lang, len(listed)), "phrase": listed, "n": n}))
        sums = pa.concat_tables(tables).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        sums = sums.filter(pc.greater_equal(sums["n_sum"], rule.least_count))
        size = pc.add(pc.count_substring(sums["phrase"], " "), 1).cast(pa.int32())
        return pa.table({"lang": sums["lang"], "size": size, "phrase": sums["phrase"], "a": sums["n_sum"]})

    return packed.groupBy("part").applyInArrow(run, COUNTS)


def _bit_map(reached: DataFrame, rule: Rule) -> np.ndarray:
    """Map of keys. The driver gets one row for each segment of the map, a fixed number at most."""
    place = (F.shiftright("key", 1).bitwiseAND(F.lit(rule.map_bits - 1)) + 1).alias("place")  # Spark numbers bits and segments from 1
    segments = reached.select(place).groupBy(F.bitmap_bucket_number("place").alias("segment")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"),
    )
    out = np.zeros(rule.map_bits // 8, np.uint8)
    for row in segments.collect():
        size = len(row["bits"])
        out[(row["segment"] - 1) * size : row["segment"] * size] = np.frombuffer(row["bits"], np.uint8)
    return out


def _broadcast_if(small: bool):
    return F.broadcast if small else lambda df: df


def _shorter(phrase: str, last: bool) -> Column:
    """The phrase without its last or its first word."""
    if last:
        return F.expr(f"left({phrase}, length({phrase}) - length(substring_index({phrase}, ' ', -1)) - 1)")
    return F.expr(f"substring({phrase}, instr({phrase}, ' ') + 1)")


def count_phrases(df: DataFrame, rule: Rule = Rule(), text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, a) of all phrases with at least ``least_count`` occurrences, and (lang, n) of all words."""
    spark = df.sparkSession
    bounded_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    folder = new_folder(spark, "phrases")
    texts = df.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    _numbered(texts, rule).write.partitionBy("shard").option("compression", "zstd").parquet(f"{folder}/chunks")
    chunks = spark.read.schema(CHUNK).parquet(f"{folder}/chunks")
    n_words = chunks.agg(F.sum("n")).first()[0] or 0
    parts = 1 << (max(rule.least_parts, -(-n_words // rule.part_words)) - 1).bit_length()
    share = -(-rule.least_count // rule.shards)

    step, open_until, maps, n_reached, steps = 0, rule.shards, None, 0, []
    whole = np.zeros(rule.map_bits // 8, np.uint8)
    while step < open_until:
        tallies = _scan(chunks.filter(F.col("shard") == step % rule.shards), rule, parts, step < rule.shards, maps)
        found = _with_share(tallies, share)
        if step:
            known = spark.read.schema(REACHED).parquet(*[f"{folder}/reached/{s}" for s in range(step)])
            found = found.join(_broadcast_if(n_reached <= FEW)(known), "key", "left_anti")
        with shuffles_removed(spark):
            found.write.parquet(f"{folder}/reached/{step}")
        found = spark.read.schema(REACHED).parquet(f"{folder}/reached/{step}")
        shorter, n_found = found.agg(F.count_if(F.col("key").bitwiseAND(F.lit(1)) == 0), F.count("*")).first()
        steps = [*steps, _bit_map(found, rule)][-rule.shards :]
        whole |= steps[-1]
        n_reached += n_found
        step += 1
        if shorter:
            open_until = max(open_until, step + rule.shards)
        if maps is not None:
            maps.unpersist()
        maps = spark.sparkContext.broadcast((whole.tobytes(), np.bitwise_or.reduce(steps).tobytes()))
    with shuffles_removed(spark):
        counts = materialize(_frequent(_counted(chunks, rule, parts, maps), rule))
    maps.unpersist()
    return counts, materialize(chunks.groupBy("lang").agg(F.sum("n").alias("n")).filter("n > 0"))


def mine_phrases(df: DataFrame, rule: Rule = Rule(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of each language."""
    counts, words = count_phrases(df, rule, text_col, lang_col)
    candidates = counts.filter("size > 1")

    def shorter(last: bool) -> DataFrame:
        return candidates.filter("size > 2").select("lang", _shorter("phrase", last).alias("phrase"), F.col("a").alias("whole"))

    held = shorter(True).unionByName(shorter(False)).groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    # Whatever longer candidate holds a phrase, one that is a word longer has at least its count.
    kept = candidates.join(held, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("whole") < rule.contained_percent * F.col("a"), F.lit(True))
    )
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring(phrase, length(head) + 2)"))
    few = _broadcast_if(small_enough(counts, FEW))
    for name, short in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(few(counts.select("lang", F.col("phrase").alias(name), F.col("a").alias(short))), ["lang", name])
    cuts = cuts.join(_broadcast_if(small_enough(words, FEW))(words), "lang")
    # Products of three numbers under 10**12 stay within 38 digits.
    score = F.expr("(1000 * CAST(a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(19, 0))) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = rows.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= rule.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
