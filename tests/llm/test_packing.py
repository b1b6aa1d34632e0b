import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest_llm import ODD
from tokenizers import Tokenizer

from millwright.llm import packing
from millwright.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, got, capacity):
    """Every piece is its document's own, in order; sequences are full without gaps."""
    tokenizer = Tokenizer.from_file(PATH)
    ids = [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in rows]
    want = []
    for doc_id, own in ids:
        first = len(own) % capacity or capacity
        cuts = [(0, first), *((i, capacity) for i in range(first, len(own), capacity))]
        for k, (start, n) in enumerate(cuts):
            want.append((doc_id, k, start, n, zlib.crc32(np.array(own[start : start + n], "<u4").tobytes())))
    have = [(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got]
    assert sorted(have, key=str) == sorted(want, key=str)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        ends = 0
        for offset, n in sorted(parts):
            assert offset == ends
            ends += n
        assert ends <= capacity
    least = -(-sum(len(own) for _, own in ids) // capacity)
    return len(sequences), least


@pytest.mark.parametrize("capacity", [2048, 300])
def test_against_the_tokenizer(spark, rows_of, capacity):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    used, least = check(rows_of("documents", "doc_id, text"), packing.pack(docs, PATH, capacity).collect(), capacity)
    assert used <= least * 1.02 + 2


def test_odd_rows(documents):
    used, least = check([r[:2] for r in ODD], packing.pack(documents(*ODD), PATH, 512).collect(), 512)
    assert used <= least + 1


def test_empty_table(documents):
    assert packing.pack(documents(), PATH).collect() == []


def test_equal_sizes(documents):
    rows = [(i, "the same") for i in range(50)]
    used, least = check(rows, packing.pack(documents(*rows), PATH, 7).collect(), 7)
    assert used == 25


@pytest.mark.parametrize("text", ["", " a", "a  b\n\n c ", "\t\ta \x0b b", "é  ", "日本 語", "a\x1c b", "a b", "don't 'll x", "<|endoftext|> a", "a<|endoftext|>"])
def test_encoder_gives_the_tokenizer_s_ids(text):
    encode = packing.Encoder(PATH)
    assert encode(text).tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_go_through_the_library():
    encode = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encode.fast is None
    assert encode("Some Words").tolist() == encode.tokenizer.encode("Some Words", add_special_tokens=False).ids


def test_sweep_takes_successor_gaps_largest_pieces_first():
    assert packing.sweep({5: 2, 3: 4}, {4: 1, 6: 1, 9: 5}) == [(6, 0, 1, 5, 1), (9, 0, 1, 5, 1), (4, 0, 1, 3, 1), (9, 1, 1, 3, 3)]
    assert packing.sweep({5: 1}, {4: 9}) == []


def test_merges_in_another_order_than_the_ids(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    assert packing.Encoder(PATH).fast is not None
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    encode, same = packing.Encoder(path), Tokenizer.from_file(path)
    assert encode.fast is None
    text = "The merges of this vocabulary come in another order."
    assert encode(text).tolist() == same.encode(text, add_special_tokens=False).ids != packing.Encoder(PATH)(text).tolist()
