import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starbrook.llm import packing
from starbrook.llm.bpe import Ranks


@pytest.fixture(scope="module")
def ranks():
    return Ranks.from_tokenizers(public_tokenizers.path(packing.VOCABULARY))


def check_places(found):
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.SEQUENCE
    return len(sequences)


def test_pieces_are_those_of_the_tokenizer(spark, documents, rows, ranks):
    found = packing.pack(packing.pieces(documents, ranks)).collect()
    own = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    want = set()
    for doc_id, text in rows:
        ids = [*own.encode(text, add_special_tokens=False).ids, packing.CLOSING_ID]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want.add((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    assert {tuple(r)[:5] for r in found} == want and len(found) == len(want)
    total = sum(r.length for r in found)
    assert check_places(found) <= 1.02 * -(-total // 1024) + 1


def test_added_tokens_are_those_of_the_tokenizer(spark, ranks):
    end = "<|endoftext|>"
    texts = [f"a{end}b", end, f"{end}{end} it's", f"two  {end}  blanks \n{end}\n", f"<|endoftext|{end}|>", f"é{end}s",
             "<|endoftext |>", f"it'{end}s", f"{end}" * 1500, "\t \n" + end, " " * 1_200_000 + f"x{end} y"]
    own, tokens = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY)), packing.Tokens(ranks)
    want = [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 50256, 65]
    assert [tokens.ids(t).tolist() for t in texts] == want
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = packing.pieces(rows, ranks).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in found} == {k: len(ids) + 1 for k, ids in enumerate(want)}


def test_odd_rows(odd, none, ranks):
    found = packing.pack(packing.pieces(odd, ranks)).collect()
    check_places(found)
    assert {r.length for r in found if r.doc_id in (1, 2)} == {1}
    assert sum(r.doc_id == 6 for r in found) == 2
    assert packing.pack(packing.pieces(none, ranks)).collect() == []


def test_white_space_too_long_for_the_pattern_engine(ranks):
    text = " " * 1_200_000 + "x"
    assert packing.Tokens(ranks).ids(text).tolist() == packing.Tokens(ranks).arrays.encode([text]).ids.tolist()


def test_best_fit_and_closing():
    bins = packing.BestFit(most_open=2, size=10)
    assert [bins.place(n) for n in (6, 7, 3)] == [(0, 0), (1, 0), (1, 7)]  # 3 fits best beside 7
    assert bins.place(5) == (2, 0)
    assert bins.place(8) == (3, 0)  # the fullest (0, with 4 left) closes
    assert bins.place(4) == (2, 5)
    assert bins.place(10) == (4, 0)
    assert bins.place(2) == (3, 8)


def test_cuts():
    assert packing.cut(1024) == [(0, 1024)]
    assert packing.cut(1025) == [(0, 1), (1, 1024)]
    assert packing.cut(2048) == [(0, 1024), (1024, 1024)]
