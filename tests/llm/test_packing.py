"""Packing: every id once, no padding, costs in balance; the encoder against the library."""
import random
import sys
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from fixtures import documents, table  # isort: skip
from martlane.llm.characters import all_settled, is_settled
from martlane.llm.packing import Encoder, Piece, capacities_of, deal, pack, pack_stream, parts, piece_cost
from martlane.llm.queries import op13_packing, vocabulary_path

RANKS = "byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def encoder():
    with open(vocabulary_path()) as f, open(vocabulary_path(RANKS), "rb") as g:
        return Encoder(f.read(), g.read())


def whole(sequence):
    """Whether the pieces' offsets are gapless and no padding is due."""
    at = 0
    for offset, n in sorted(sequence):
        if offset != at or n < 1:
            return False
        at += n
    return at <= 1024 and (at == 1024 or at & at - 1 == 0)


def test_query_packs_every_id_once(spark, tmp_path, library):
    rows = documents() + [(200, "<|endoftext|> a<|endoftext|>\n b", "en"), (201, "𐵀 ՘'s ՘ 😀 ok x\u0085y", "en"), (202, "x" * 70_000, "en")]
    table(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = op13_packing(spark, str(tmp_path)).collect()
    want = defaultdict(list)
    for i, text, _ in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want[i].append(ids)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.doc_tokens].append((r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert all(map(whole, sequences.values()))
    assert sum(r.length for r in got) == sum(len(x) for same in want.values() for x in same)
    for (doc, tokens), found in pieces.items():
        texts = [x for x in want[doc] if len(x) == tokens]
        assert texts and len(found) >= len(texts)
        # rows that share an id and a length are told apart by their sums
        if len(texts) == 1:
            at = 0
            for start, n, crc in sorted(found):
                assert start == at and crc == zlib.crc32(texts[0][start:start + n].tobytes())
                at += n
            assert at == tokens


def test_empty_table(spark):
    assert pack(table(spark, []), vocabulary_path(), vocabulary_path(RANKS)).count() == 0


def test_ids_column_holds_the_text(spark, library):
    rows = [(1, "The cat sat on the mat.", "en"), (2, None, "en")]
    got = {r.doc_id: r for r in pack(table(spark, rows), vocabulary_path()).collect()}  # without ranks
    assert library.decode(np.frombuffer(got[1].ids, dtype="<u4")[:-1].tolist(), skip_special_tokens=False) == rows[0][1]
    assert got[2].ids == b"\0\0\0\0" and got[2].doc_tokens == 1


@pytest.mark.parametrize("capacity, block", [(16, 100), (64, 64), (64, 10**6), (8, 1000)])
def test_stream_has_no_padding(capacity, block):
    rng = random.Random(capacity + block)
    docs = [(i, np.arange(i * 1000, i * 1000 + rng.choice([1, 1, 2, 5, capacity - 1, capacity, capacity + 1, rng.randint(1, 9 * capacity)]), dtype="<u4"))
            for i in range(400)]
    seen, sequences = [], defaultdict(list)
    for placed in pack_stream(iter(docs), capacity, block):
        for k, offset, piece in placed:
            seen.append(piece.ids)
            assert piece.ids[0] == piece.row[0] * 1000 + piece.start
            sequences[k].append((offset, len(piece.ids)))
    assert sorted(np.concatenate(seen).tolist()) == sorted(np.concatenate([d[1] for d in docs]).tolist())
    lengths = []
    for own in sequences.values():
        ends = np.cumsum([n for _, n in own])
        assert [o for o, _ in own] == [0, *ends[:-1]]
        lengths.append(int(ends[-1]))
    assert all(n == capacity or n & n - 1 == 0 for n in lengths)
    assert sum(n < capacity for n in lengths) <= capacity.bit_length()  # of the last block only


def test_deal_is_the_greedy_rule():
    """Against a plain version: descending, lowest cost with room, cut at the most room."""
    rng = random.Random(8)
    for _ in range(30):
        pieces = [Piece((i, 0), 0, np.zeros(rng.randint(1, 60), dtype="<u4")) for i in range(40)]
        sizes = capacities_of(sum(len(p.ids) for p in pieces), 64, True)
        placed, rest = deal(pieces, sizes)
        assert not rest and sum(len(p.ids) for *_, p in placed) == sum(sizes)
        used, cost = [0] * len(sizes), [0.0] * len(sizes)
        queue = [(-len(p.ids), i) for i, p in enumerate(pieces)]
        want, later = [], len(queue)
        while queue:
            queue.sort()
            n, order = queue.pop(0)
            n = -n
            fits = [(cost[k], k) for k in range(len(sizes)) if sizes[k] - used[k] >= n]
            if fits:
                k = min(fits)[1]
            else:
                k = max(range(len(sizes)), key=lambda k: (sizes[k] - used[k], -k))
                queue.append((-(n - (sizes[k] - used[k])), later))
                later += 1
                n = sizes[k] - used[k]
            want.append((k, used[k], n))
            used[k] += n
            cost[k] += piece_cost(n)
        assert [(k, o, len(p.ids)) for k, o, p in placed] == sorted(want)


def test_costs_are_balanced():
    """Sequences cost more alike than when each piece goes to the first one with room."""
    rng = random.Random(4)
    pieces = [Piece((i, 0), 0, np.zeros(rng.choice([20, 50, 300, 400]), dtype="<u4")) for i in range(2000)]
    sizes = capacities_of(sum(len(p.ids) for p in pieces), 1024, False)
    cost, plain, room = np.zeros(len(sizes)), np.zeros(len(sizes)), np.array(sizes)
    for k, _, p in deal(pieces, sizes)[0]:
        cost[k] += piece_cost(len(p.ids))
    for n in sorted((len(p.ids) for p in pieces), reverse=True):
        while n and room.any():
            k = int((room >= n).argmax()) if (room >= n).any() else int(room.argmax())
            step = min(n, int(room[k]))
            plain[k], room[k], n = plain[k] + piece_cost(step), room[k] - step, n - step
    assert cost.std() < plain.std()


def test_encoder_matches_library(encoder, library):
    rng = random.Random(2)
    signs = ["a", "é", "日", "1", "٣", " ", "  ", "\n", "\t", "'s", "'ll", "!", "--", "😀", "՘", "\u0085", "᠎", "​", "<|endoftext|>", "\x1c", "ſ", "𐵀", " "]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 12)))
        assert encoder.ids(text).tolist() == library.encode(text, add_special_tokens=False).ids, text
    long = " ".join(rng.choice(signs) * rng.randint(1, 3) for _ in range(60_000))
    assert len(list(parts(long))) > 2 and "".join(parts(long)) == long
    assert encoder.ids(long).tolist() == library.encode(long, add_special_tokens=False).ids


def test_all_settled_characters_match(encoder, library):
    """Every settled character, between a letter, a digit, a sign and spaces."""
    points = [chr(i) for i in range(sys.maxunicode + 1) if is_settled(chr(i))]
    assert len(points) > 80_000 and not all_settled("a՘") and not all_settled("😀") and all_settled("é\n日")
    assert all(unicodedata.category(c) != "Cn" for c in points)
    for at in range(0, len(points), 4000):
        text = "\n".join(f"c{c}c1{c}1!{c}'s {c}" for c in points[at:at + 4000])
        assert encoder.fast.encode(text, allowed_special="all") == library.encode(text, add_special_tokens=False).ids
