import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_cases import documents
from tokenizers import Tokenizer

from gridcast.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(1, "Hello world"), (2, None), (3, ""), (4, "long " * 9000), (5, "Hello world"), (5, "Hello world"), (None, "no id"),
        (6, "special <|endoftext|> inside"), (7, "naïve ünïcödé 中文 🙂\n\n  tabs\t"), (8, "x" * 5000)]


def check(rows, pieces, length):
    coder = Tokenizer.from_file(PATH)
    ids = {(i, t): [*coder.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    total = sum(len(ids[r]) for r in rows)
    assert sum(p.length for p in pieces) == total
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t)
    for p in pieces:
        own = [np.array(ids[p.doc_id, t][p.start:p.start + p.length], "<u4").tobytes() for t in texts[p.doc_id]]
        assert bytes(p.ids) in own and p.ids_crc32 == zlib.crc32(bytes(p.ids))
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
    ends = []
    for number in range(len(by_sequence)):
        at = 0
        for offset, n in sorted(by_sequence[number]):
            assert offset == at
            at += n
        ends.append(at)
    assert all(e == length for e in ends[:-1]) and 0 < ends[-1] <= length


@pytest.mark.parametrize("length", [7, 2048])
def test_every_id_lies_in_one_piece(spark, length):
    check(ROWS, packing.pack(documents(spark, ROWS, clashing=True), PATH, length=length).collect(), length)


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).collect() == []


def test_ids_are_those_of_the_library(spark):
    coder, own = Tokenizer.from_file(PATH), packing.encoding(PATH)
    for _, t in ROWS:
        assert list(own.encode_to_numpy(t or "", allowed_special="all")) == coder.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    side = 1 << bits
    points = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = packing.hilbert(points, bits)
    assert sorted(keys) == list(range(side ** dims))
    path = points[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_similar_documents_are_neighbours(spark):
    rows = [(i, " ".join(f"{'abc'[i % 3]}{j % 40}" for j in range(i % 7, 200 + i % 5))) for i in range(60)]
    pieces = packing.pack(documents(spark, rows), PATH, length=1 << 20).collect()
    order = [p.doc_id % 3 for p in sorted(pieces, key=lambda p: p.offset)]
    assert sum(a != b for a, b in zip(order, order[1:])) <= 8
