import hashlib
import random

import public_tokenizers as public
import pytest
import tiktoken

from .conftest import AWKWARD, small

from tradeglass.llm.byte_bpe import ByteBPE, decode, encode, encoded_digests
from tradeglass.llm.queries import QUERIES

PATH = public.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, "rb") as file:
        return ByteBPE(file.read(), public.PATTERN)


@pytest.fixture(scope="module")
def reference(bpe):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def expected(rows, reference):
    made = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        decoded = reference.decode_bytes(ids)
        assert decoded == (t or "").encode()
        made.append(
            str((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
        )
    return sorted(made)


def test_random_texts(bpe, reference):
    random.seed(1)
    letters = "ab \n\t  é's't1２ 　\xa0,.!\x1c\x85\0日本"
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 14))) for _ in range(4_000)]
    texts += ["".join(random.choice("abcdefghßü") for _ in range(random.randint(1, 90))) for _ in range(500)]
    texts += ["<|endoftext|>", "ab" * 5_000, " " * 3_000]
    assert [[int(i) for i in x.split(",")] if x else [] for x in bpe.encode_all(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_one_tree_equals_many(bpe):
    for piece in ("ababab", "x", "ähnlich", "qqqqqqqqqqqqqqqq", "z" * 200):
        assert ",".join(map(str, bpe.merge(piece.encode()))) == bpe.merge_all([piece.encode()])[0]


def test_awkward_rows(awkward, reference):
    found = encoded_digests(awkward, PATH, public.PATTERN)
    assert sorted(str(tuple(r)) for r in found.collect()) == expected(AWKWARD, reference)


def test_round_trip(awkward):
    encoded = encode(awkward, PATH, public.PATTERN)
    back = decode(encoded, PATH, public.PATTERN)
    assert sorted(str((r.doc_id, bytes(r.decoded).decode())) for r in back.collect()) == sorted(str((i, t or "")) for i, t in AWKWARD)


def test_query_and_empty_table(llm, documents, reference):
    rows = [(r.doc_id, r.text) for r in small(llm, "documents").collect()]
    found = QUERIES["op3_byte_bpe"](llm, "/root/testdata/sf0.001").collect()
    assert sorted(str(tuple(r)) for r in found) == expected(rows, reference)
    assert encoded_digests(documents([]), PATH, public.PATTERN).count() == 0
