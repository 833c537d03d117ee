"""Cost-balanced packing of documents into training sequences.

A document's ids (with an end id behind them) are cut into pieces of at most ``capacity``
tokens.  A piece of n tokens is estimated to cost ``LINEAR`` n + ``QUADRATIC`` n², the second
term for attention, which stays inside a piece.  Pieces are dealt in descending order, each to
the sequence of the lowest cost so far that still has room for it; a piece that fits nowhere
whole is cut at the sequence with the most room, and the rest of it is dealt on.

Packing needs no shuffle and no global state.  A task streams its documents, writes whole
pieces of ``capacity`` tokens at once as sequences of their own, and gathers the rest until it
has ``BLOCK_TOKENS`` tokens; these are dealt to as many sequences as they fill, and what is
left over goes on to the next block.  The last block of a task also gets sequences whose
lengths are the powers of two that add up to its remainder, so nothing is padded: padding is
only needed for a length that is neither ``capacity`` nor a power of two.  Memory is bounded by
a block (and by one document); a lost executor repeats its own input split and nothing else.

Ids are those of the ``tokenizers`` library.  Its slower encoder is only used where a text has
characters that libraries class differently; other text goes to an encoder of the same
vocabulary (``ranks``) that is some four times as fast.  Long texts are encoded in parts, cut
before a single space between two other characters, where no token can cross.

Cases: a null or empty text is the end id alone; rows are packed one by one, so repeated rows,
ties and null ids need no care (ties are dealt in input order); an empty table gives no rows.
Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame

from martlane.llm.bpe import PRE_TOKEN
from martlane.llm.characters import all_settled
from martlane.llm.common import small_batches

CAPACITY, END = 1024, 0
LINEAR, QUADRATIC = 1.0, 1 / 4096
#: Tokens that a task deals at once.
BLOCK_TOKENS = 1 << 20
#: Characters of a text that are encoded at once.
PART = 1 << 16
#: Sequence ids of a task begin at its number times this.
IDS_PER_TASK = 1 << 40
CUT_BEFORE = regex.compile(r"(?<=[\p{L}\p{N}\p{P}]) (?=[\p{L}\p{N}\p{P}])")


def parts(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts of about ``size`` characters, cut where no token can cross."""
    at = 0
    while len(text) - at > size:
        found = CUT_BEFORE.search(text, at + size)
        if not found:
            break
        yield text[at:found.start()]
        at = found.start()
    yield text[at:]


class Encoder:
    """Ids of a text as the ``tokenizers`` library gives them for the vocabulary file ``spec``;
    ``ranks`` are lines of base64 tokens and their ids, the same vocabulary, or None."""

    def __init__(self, spec: str, ranks: bytes | None):
        from tokenizers import Tokenizer
        self.exact = Tokenizer.from_str(spec)
        self.exact.no_truncation()
        self.exact.no_padding()
        self.fast = None
        if ranks is not None:
            import tiktoken
            known = {base64.b64decode(token): int(i) for token, i in map(bytes.split, ranks.splitlines())}
            special = {t.content: i for i, t in self.exact.get_added_tokens_decoder().items()}
            self.fast = tiktoken.Encoding("packing", pat_str=PRE_TOKEN, mergeable_ranks=known, special_tokens=special)

    def ids(self, text: str) -> np.ndarray:
        found = []
        for part in parts(text):
            if self.fast is not None and all_settled(part):
                found.append(np.asarray(self.fast.encode_to_numpy(part, allowed_special="all"), dtype="<u4"))
            else:
                found.append(np.array(self.exact.encode(part, add_special_tokens=False).ids, dtype="<u4"))
        return np.concatenate(found)


def piece_cost(tokens: int) -> float:
    return LINEAR * tokens + QUADRATIC * tokens * tokens


@dataclass(frozen=True)
class Piece:
    row: tuple  # (doc_id, doc_tokens)
    start: int
    ids: np.ndarray

    def split(self, n: int) -> tuple[Piece, Piece]:
        return Piece(self.row, self.start, self.ids[:n]), Piece(self.row, self.start + n, self.ids[n:])


def deal(pieces: list[Piece], capacities: list[int]) -> tuple[list[tuple[int, int, Piece]], list[Piece]]:
    """Deal pieces to sequences of the given capacities: (sequence, offset, piece) of what was
    dealt, in that order, and the pieces that found no room at all."""
    full, room = np.array(capacities, dtype=np.int64), np.array(capacities, dtype=np.int64)
    cost = np.zeros(len(capacities))
    queue = [(-len(p.ids), i, p) for i, p in enumerate(pieces)]
    heapq.heapify(queue)
    placed: list[tuple[int, int, Piece]] = []
    rest: list[Piece] = []
    left, later = int(room.sum()), len(queue)
    while queue:
        _, order, piece = heapq.heappop(queue)
        if not left:
            rest.append(piece)
            continue
        open_cost = np.where(room >= len(piece.ids), cost, np.inf)
        k = int(open_cost.argmin())
        if open_cost[k] == np.inf:
            k = int(room.argmax())
            piece, tail = piece.split(int(room[k]))
            heapq.heappush(queue, (-len(tail.ids), later, tail))
            later += 1
        n = len(piece.ids)
        placed.append((k, int(full[k] - room[k]), piece))
        room[k] -= n
        cost[k] += piece_cost(n)
        left -= n
    return sorted(placed, key=lambda x: x[:2]), rest


def capacities_of(tokens: int, capacity: int, last: bool) -> list[int]:
    """Lengths of the sequences for so many tokens: whole ones, and for the last block also the
    powers of two that the rest is made of."""
    whole, rest = divmod(tokens, capacity)
    return [capacity] * whole + [1 << b for b in reversed(range(rest.bit_length())) if last and rest >> b & 1]


def pack_stream(documents: Iterator[tuple[object, np.ndarray]], capacity: int, block: int
                ) -> Iterator[list[tuple[int, int, Piece]]]:
    """Blocks of (sequence, offset, piece), sequences numbered from 0, of (doc_id, ids) rows."""
    sequence, waiting, tokens = 0, [], 0

    def packed(last: bool) -> list[tuple[int, int, Piece]]:
        nonlocal sequence, waiting, tokens
        sizes = capacities_of(tokens, capacity, last)
        placed, waiting = deal(waiting, sizes)
        tokens = sum(len(p.ids) for p in waiting)
        out = [(sequence + k, offset, piece) for k, offset, piece in placed]
        sequence += len(sizes)
        return out

    for doc_id, ids in documents:
        piece = Piece((doc_id, len(ids)), 0, ids)
        whole = []
        while len(piece.ids) >= capacity:
            first, piece = piece.split(capacity)
            whole.append((sequence, 0, first))
            sequence += 1
        if whole:
            yield whole
        if len(piece.ids):
            waiting.append(piece)
            tokens += len(piece.ids)
        if tokens >= block:
            yield packed(False)
    if waiting:
        yield packed(True)


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, capacity: int = CAPACITY,
         end: int = END, block: int = BLOCK_TOKENS) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: one row per piece.

    ``vocabulary`` and ``ranks`` are paths on the driver; ``ids`` are the piece's ids as
    little-endian unsigned 32-bit integers.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    known = None
    if ranks:
        with open(ranks, "rb") as f:
            known = f.read()
    shared = spark.sparkContext.broadcast((spec, known))
    doc_kind = docs.schema["doc_id"].dataType
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, kinds = Encoder(*shared.value), None
        first_id = TaskContext.get().partitionId() * IDS_PER_TASK
        ending = np.array([end], dtype="<u4")

        def documents() -> Iterator[tuple[object, np.ndarray]]:
            nonlocal kinds
            for batch in batches:
                kinds = batch.schema.field("doc_id").type
                for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                    yield doc_id, np.concatenate([encoder.ids(text), ending]) if text else ending

        held: list[tuple[int, int, Piece]] = []
        for placed in pack_stream(documents(), capacity, block):
            held += placed
            if len(held) >= 256:
                yield rows(held, kinds, first_id)
                held = []
        if held:
            yield rows(held, kinds, first_id)

    def rows(placed: list[tuple[int, int, Piece]], kind: pa.DataType, first_id: int) -> pa.RecordBatch:
        long = lambda values: pa.array(values, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([p.row[0] for *_, p in placed], kind), long([p.start for *_, p in placed]),
             long([len(p.ids) for *_, p in placed]), pa.array([p.ids.tobytes() for *_, p in placed], pa.binary()),
             long([p.row[1] for *_, p in placed]), long([first_id + k for k, *_ in placed]),
             long([o for _, o, _ in placed])], names)

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {doc_kind.simpleString()}, start long, length long, ids binary, doc_tokens long, "
             "sequence_id long, offset long")
