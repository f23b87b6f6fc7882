"""Vector bin packing of tokenised texts into sequences of a fixed length.

Every piece has a demand of (tokens, segments, loss-bearing tokens) and a sequence has a capacity in all three.
The dot-product heuristic fills one sequence at a time: of the pieces that fit, the one whose demand has the
largest dot product with the room that is left is placed next. When no whole piece fits, one is cut to fill the
room. A sequence that nothing fills, such as the last of a block, is cut to powers of two, which need no padding.

A task packs its own documents in blocks of about ``block_tokens`` tokens: nothing is shuffled, a block bounds the
memory, and a task that runs again on the same input split gives the same sequences.

Defined cases: null and empty texts are one end token each; texts of any length are cut into as many pieces as
needed; repeated rows are packed as often as they come; an empty table gives no piece. A null id stays null.
"""

from __future__ import annotations

import re
import sys
import types
import unicodedata
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_batches

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, loss_tokens bigint, sequence_tokens bigint"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
# Entries of the caches of a Python worker, of words and of other chunks.
CACHED_WORDS, CACHED_CHUNKS = 400_000, 50_000
# Characters of texts that are encoded together, unless one has more.
GROUP_CHARS = 2_000_000


@dataclass(frozen=True)
class Limits:
    """Capacity of a sequence, and how documents may be cut."""

    tokens: int = 4096
    segments: int = 512
    loss_tokens: int = 4096
    #: Room below this many tokens is padded rather than filled with a cut piece.
    least_cut: int = 16
    block_tokens: int = 1 << 21


# Latin texts without controls or rare spaces: for them lower case, word splitting and composed form are plain.
PLAIN = re.compile(r"[\t\n\r -~\u00c0-\u024f]*")
LATIN = r"a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
# The vocabulary's own word pattern, for such texts.
WORD = re.compile(rf"[{LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\s0-9{LATIN}]+")


def _byte_signs() -> dict[int, int]:
    """Byte-level vocabularies write bytes without a visible sign as code points from 256 on; here the blank stays."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: 256 + i for i, b in enumerate(hidden) if b != 32}


class Encoder:
    """Token ids of whole texts as little-endian unsigned 32-bit integers.

    The vocabulary drops white space and never joins across it or across words. Plain Latin texts are split into its words
    here, other texts into the chunks between spaces; what was met before is looked up, and only new words and chunks go
    to the tokenizer.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.signs = _byte_signs()
        self.words, self.chunks = Cache(CACHED_WORDS), Cache(CACHED_CHUNKS)
        self.end = np.array([end_id], "<u4").tobytes()

    @classmethod
    def of_process(cls, path: str, end_id: int) -> Encoder:
        """The encoder of this Python worker; its cache outlives the task, which module globals need not."""
        store = sys.modules.setdefault("_worker_encoders", types.ModuleType("_worker_encoders"))
        found = vars(store).setdefault("by_path", {})
        if (path, end_id) not in found:
            found[path, end_id] = cls(path, end_id)
        return found[path, end_id]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text with the end; texts are taken together, up to GROUP_CHARS, so that new chunks are encoded at once."""
        out: list[bytes] = []
        start = chars = 0
        for i, text in enumerate(texts):
            chars += len(text)
            if chars >= GROUP_CHARS or i + 1 == len(texts):
                out += self._group(texts[start : i + 1])
                start, chars = i + 1, 0
        return out

    def _group(self, texts: list[str]) -> list[bytes]:
        plain = [bool(PLAIN.fullmatch(t)) and "<|" not in t and unicodedata.is_normalized("NFC", t) for t in texts]
        lists = [WORD.findall(t.lower()) if p else t.replace("\n", " ").split(" ") for t, p in zip(texts, plain)]
        words = self.words.holding({w for listed, p in zip(lists, plain) if p for w in listed}, self._word_ids)
        chunks = self.chunks.holding({c for listed, p in zip(lists, plain) if not p for c in listed}, self._whole_ids)
        return [b"".join(map((words if p else chunks).__getitem__, listed)) + self.end for listed, p in zip(lists, plain)]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """The model takes bytes as visible signs; all words are rewritten at once."""
        tokenize = self.tokenizer.model.tokenize
        signs = " ".join(words).encode().decode("latin-1").translate(self.signs).split(" ")
        return [array("I", [t.id for t in tokenize(s)]).tobytes() for s in signs] if words else []

    def _whole_ids(self, chunks: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch(chunks, add_special_tokens=False)]


class Cache:
    """What was encoded lately: two generations, of which the older goes when the newer is full."""

    def __init__(self, most: int):
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most = most // 2

    def holding(self, parts: set[str], encode) -> dict[str, bytes]:
        """A dictionary that holds all ``parts``."""
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        missing = [p for p in parts if p not in new]
        if old:
            new.update((p, old[p]) for p in missing if p in old)
            missing = [p for p in missing if p not in new]
        if missing:
            new.update(zip(missing, encode(missing)))
        return new


class Packer:
    """Packs the documents of one task; ``take`` and ``finish`` return rows of SCHEMA."""

    def __init__(self, limits: Limits, first_id: int):
        self.limits, self.next_id = limits, first_id
        # Open rests of documents: [doc, start, length]; docs hold (id, ids, tokens, bears loss).
        self.docs: list[tuple] = []
        self.held = 0
        self.rows: list[tuple] = []

    def take(self, doc_id, ids: bytes, bears_loss: bool) -> None:
        self.docs.append((doc_id, ids, len(ids) // 4, bears_loss))
        self.held += len(ids) // 4
        if self.held >= self.limits.block_tokens:
            self.pack()

    def emit(self, pieces: list[tuple[int, int, int]]) -> None:
        """One sequence of (doc, start, length)."""
        offset, total = 0, sum(p[2] for p in pieces)
        for doc, start, length in pieces:
            doc_id, ids, tokens, bears_loss = self.docs[doc]
            crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + length)])
            self.rows.append((doc_id, start, length, crc, tokens, self.next_id, offset, length * bears_loss, total))
            offset += length
        self.next_id += 1

    def pack(self) -> None:
        """Packs what is held. A sequence that can't be filled is cut to powers of two."""
        lim = self.limits
        rest: list[list[int]] = []
        for doc, (_, _, tokens, bears_loss) in enumerate(self.docs):
            most = min(lim.tokens, lim.loss_tokens) if bears_loss else lim.tokens
            whole = tokens // most * most
            for start in range(0, whole, most):
                if most == lim.tokens:
                    self.emit([(doc, start, most)])
                else:
                    rest.append([doc, start, most])
            if tokens > whole:
                rest.append([doc, whole, tokens - whole])
        # By whether they bear loss, open pieces as (length, -number) in order. Within a class the product grows with the
        # length, so its best piece is the longest that fits; of equal ones the first.
        open_: dict[bool, list[tuple[int, int]]] = {False: [], True: []}
        for k, (doc, _, length) in enumerate(rest):
            open_[bool(self.docs[doc][3])].append((length, -k))
        for listed in open_.values():
            listed.sort()
        while open_[False] or open_[True]:
            room, slots, loss_room, pieces = lim.tokens, lim.segments, lim.loss_tokens, []
            while slots >= 1:
                best = None
                for bears, listed in open_.items():
                    at = bisect_right(listed, (min(room, loss_room) if bears else room, 1)) - 1
                    if at >= 0:
                        length, k = listed[at]
                        # All products have the same share for the segment.
                        gain = room * length / lim.tokens**2 + (loss_room * length / lim.loss_tokens**2 if bears else 0)
                        best = max(best or (-1.0,), (gain, k, bears, at))
                if best:
                    _, _, bears, at = best
                    length, k = open_[bears].pop(at)
                    left = length
                else:
                    # The longest piece is cut, so that documents stay whole where they can.
                    longest = [(*listed[-1], bears) for bears, listed in open_.items() if listed and (min(room, loss_room) if bears else room) >= lim.least_cut]
                    if not longest:
                        break
                    left, k, bears = max(longest)
                    open_[bears].pop()
                    length = min(room, loss_room) if bears else room
                doc, start, _ = rest[-k]
                pieces.append((doc, start, length))
                rest[-k] = [doc, start + length, left - length]
                if left > length:
                    insort(open_[bears], (left - length, k))
                room, slots, loss_room = room - length, slots - 1, loss_room - length * bears
            if room < lim.least_cut:
                self.emit(pieces)
            else:
                self.emit_in_powers(pieces)
        self.docs, self.held = [], 0

    def emit_in_powers(self, pieces: list[tuple[int, int, int]]) -> None:
        """Cuts the pieces into sequences whose lengths are powers of two."""
        total = sum(p[2] for p in pieces)
        pieces = list(pieces)
        while total:
            want = 1 << (total.bit_length() - 1)
            total -= want
            part = []
            while want:
                doc, start, length = pieces.pop(0)
                used = min(want, length)
                part.append((doc, start, used))
                if used < length:
                    pieces.insert(0, (doc, start + used, length - used))
                want -= used
            self.emit(part)

    def drain(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack_texts(
    df: DataFrame,
    tokenizer_path: str,
    end_id: int = 2,
    limits: Limits = Limits(),
    id_col: str = "doc_id",
    text_col: str = "text",
    loss_col: str | None = None,
) -> DataFrame:
    """One row per piece. ``loss_col`` names a boolean column: whether the tokens of a row bear loss (default: all)."""
    bounded_batches(df.sparkSession)
    bears = F.coalesce(F.col(loss_col).cast("boolean"), F.lit(False)) if loss_col else F.lit(True)
    source = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), bears.alias("bears"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        encoder = Encoder.of_process(tokenizer_path, end_id)
        packer = Packer(limits, (context.partitionId() if context else 0) << 33)
        for batch, texts in text_batches(batches):
            ids, flags = batch.column("doc_id").to_pylist(), batch.column("bears").to_pylist()
            for doc_id, found, flag in zip(ids, encoder.encode_all(texts), flags):
                packer.take(doc_id, found, flag)
            if packer.rows:
                yield _batch(packer.drain())
        packer.pack()
        if packer.rows:
            yield _batch(packer.drain())

    return source.mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], NAMES)
