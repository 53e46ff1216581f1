import base64
import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from starbrook.llm import bpe

LETTERS = " \t\n\r'''''stmdrvlelLLeexyzABÉ1239½一。.,!?- \u2003\u0085\u200bé😀\u0301"


@pytest.fixture(scope="module")
def ranks():
    return bpe.Ranks.from_tiktoken(public_tokenizers.path(bpe.MULTI))


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path(bpe.MULTI), "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@pytest.fixture(scope="module")
def texts(rows):
    rng = random.Random(5)
    mixed = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 40))) for _ in range(5_000)]
    long = ["a" * 5_000, "ab" * 3_000 + "'" * 200, "\n" * 300, " " * 301 + "x", "don't we'll 's's ''s o'm <|endoftext|>"]
    return [*mixed, *long, "", *(t for _, t in rows)]


def test_pieces(ranks, texts):
    cut, edge = bpe.Encoder(ranks).pieces(texts)
    found = [cut[a:b] for a, b in zip(edge, edge[1:], strict=False)]
    assert found == [[m.encode() for m in regex.findall(public_tokenizers.PATTERN, t)] for t in texts]


def test_ids_and_round_trip(ranks, library, texts):
    own = bpe.Encoder(ranks)
    own.MOST_PIECES = 3_000  # the cache is emptied now and then
    for start in range(0, len(texts), 700):
        part = texts[start : start + 700]
        found = own.encode(part)
        ids = [found.ids[a:b].tolist() for a, b in zip(found.edge, found.edge[1:], strict=False)]
        assert ids == [library.encode_ordinary(t) for t in part]
        assert own.decode(found) == [t.encode() for t in part]


def test_digests(odd, none, ranks, library):
    for r in bpe.round_trip(odd, ranks).collect():
        if r.doc_id in (1, 2):
            assert (r.n_tokens, r.ids_sha256) == (0, hashlib.sha256(b"").hexdigest())
    want = []
    for r in odd.collect():
        ids, text = library.encode_ordinary(r.text or ""), r.text or ""
        sha = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.append((r.doc_id, len(ids), sha, hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, bpe.round_trip(odd, ranks).collect()), key=str) == sorted(want, key=str)
    assert bpe.round_trip(none, ranks).collect() == []


def test_tables(odd, ranks):
    encoded = bpe.encode(odd, ranks)
    texts = sorted((r.text or "").encode() for r in odd.collect())
    assert sorted(bytes(r.body) for r in bpe.decode(encoded, ranks).collect()) == texts
    for r in encoded.collect():
        assert len(r.ids) == len(r.offsets) and (not r.offsets or r.offsets[0] == 0)
