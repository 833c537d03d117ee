"""Byte-level BPE: encoding with a priority queue of merge ranks, decoding by concatenation.

Each pre-token is a doubly linked list of symbols.  The queue holds ``(rank, position)`` of
every adjacent pair that the merge table knows; a popped entry whose pair has changed since
is stale and skipped.  A pre-token's ids are kept in a table of bounded size, as most words
repeat.  The vocabulary file is read once by the driver and broadcast (its size is that of
the file, under ``MAX_VOCABULARY_BYTES``).

Text is split where the public library splits it.  Most characters are of one class everywhere
(``characters``); of any other one, such as a letter that newer Unicode versions added, the
library's own pre-tokenizer is asked for the class, once for each task.

Nulls: a null text is an empty text with no tokens.  Rows are handled one by one, so
repeated rows, ties and empty tables need no care; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martlane.llm.characters import all_settled, unsettled
from martlane.llm.common import small_batches

#: How a byte-level tokenizer splits text before merging (fixed value).
PRE_TOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A letter, a number and another sign, of which no contraction is made.
STAND_INS = "é1!"
MAX_VOCABULARY_BYTES = 64 << 20
#: The same for text of settled ASCII characters, which ``re`` splits twice as fast.
ASCII_PRE_TOKEN = r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
#: Pre-tokens whose ids a task remembers (those of the last ``MEMO`` new ones, and as many before
#: them), and the length up to which it does.
MEMO, MEMO_LENGTH = 200_000, 64


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file of the public ``tokenizers`` format."""

    def __init__(self, spec: str):
        loaded = json.loads(spec)
        model, symbols = loaded["model"], byte_symbols()
        vocab = model["vocab"]
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.byte_ids = [vocab[s] for s in symbols]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in loaded.get("added_tokens", [])}
        self.pieces: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for piece, i in vocab.items():
            self.pieces[i] = bytes(byte_of[c] for c in piece)
        for piece, i in self.special.items():
            self.pieces[i] = piece.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.pattern = regex.compile(PRE_TOKEN)
        self.spec, self.splitter = spec, None
        self.stand_ins: dict[int, str] = {}
        self.ascii_pattern = re.compile(ASCII_PRE_TOKEN)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def stand_in(self, c: str) -> str:
        """A settled character of the class that the library gives a character."""
        if self.splitter is None:
            from tokenizers import Tokenizer
            self.splitter = Tokenizer.from_str(self.spec).pre_tokenizer
        for settled in STAND_INS:
            if len(self.splitter.pre_tokenize_str(settled + c)) == 1:
                return settled
        return "\t"

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text."""
        if all_settled(text):
            return (self.ascii_pattern if text.isascii() else self.pattern).findall(text)
        for c in set(unsettled().findall(text)):
            if ord(c) not in self.stand_ins:
                self.stand_ins[ord(c)] = self.stand_in(c)
        return [text[slice(*m.span())] for m in self.pattern.finditer(text.translate(self.stand_ins))]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token."""
        ids = [self.byte_ids[b] for b in word]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(m[0], i, m[1], ids[i], ids[i + 1]) for i in range(n - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, new, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two symbols was merged away meanwhile
            ids[i], ids[j] = new, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := self.merges.get((new, ids[k])):
                    heapq.heappush(queue, (m[0], i, m[1], new, ids[k]))
            if (h := before[i]) >= 0 and (m := self.merges.get((ids[h], new))):
                heapq.heappush(queue, (m[0], h, m[1], ids[h], new))
        return [i for i in ids if i >= 0]

    def packed(self, word: str) -> bytes:
        """Ids of a pre-token that is not in the memo."""
        if len(word) > MEMO_LENGTH:
            return np.array(self.merge(word.encode()), dtype="<u4").tobytes()
        ids = self.older.get(word) or np.array(self.merge(word.encode()), dtype="<u4").tobytes()
        if len(self.memo) >= MEMO:
            self.memo, self.older = {}, self.memo
        self.memo[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = self.split.split(text) if self.split else [text]
        out, packed = [], self.packed
        for part in parts:
            if part in self.special:
                out.append(np.array([self.special[part]], dtype="<u4").tobytes())
            else:
                out.extend([self.memo.get(w) or packed(w) for w in self.words(part)])
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        pieces = self.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, vocabulary: str, keep_ids: bool = True) -> DataFrame:
    """``doc_id, n_tokens, ids (binary), ids_sha256, decoded_sha256, exact`` of every row.

    ``vocabulary`` is the path of the vocabulary file on the driver; ``exact`` tells whether
    the decoded text equals the input.  Without ``keep_ids`` the ids stay in their task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    if len(spec) > MAX_VOCABULARY_BYTES:
        raise ValueError("the vocabulary file is larger than what is broadcast")
    shared = spark.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            rows = []
            for text in batch["text"].to_pylist():
                text = text or ""
                ids = codec.encode(text)
                decoded = codec.decode(ids)
                rows.append((len(ids) // 4, ids if keep_ids else b"", hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(decoded.encode()).hexdigest(), decoded == text))
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(
                [pa.int64(), pa.binary(), pa.string(), pa.string(), pa.bool_()])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], [
                "doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256", "exact"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string, exact boolean")
