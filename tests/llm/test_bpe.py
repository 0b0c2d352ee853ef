import hashlib

import numpy as np
import public_tokenizers as P
import pytest

from tessera.llm import bpe
from tessera.llm.queries import BPE_RANKS, bpe_files
from llm_fixtures import *  # noqa: F401,F403

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(**bpe_files())


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def test_ids_equal_the_library(codec, library, rng):
    alphabet = list("abthein g1\n\t'sé") + ["ß", "中", "😀", "  ", "the", "ing"]
    for _ in range(3000):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(codec.encode(s), "<u4").tolist() == library.encode_ordinary(s)
        assert codec.decode(codec.encode(s)) == s.encode()


def test_one_long_piece_takes_linear_time(codec, library):
    s = "ab" * 40000
    assert np.frombuffer(codec.encode(s), "<u4").tolist() == library.encode_ordinary(s)


def test_table_round_trip(spark, odd_docs, no_docs, library):
    got = bpe.encode(odd_docs, **bpe_files())
    texts = sorted((r.text or "") for r in odd_docs.collect())
    back = bpe.decode(got, **bpe_files()).collect()
    assert sorted(r.text for r in back) == texts
    for r in got.collect():
        raw = np.array(r.token_ids, "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(r.token_ids), hashlib.sha256(raw).hexdigest())
    assert bpe.encode(no_docs, **bpe_files()).collect() == []
    assert BPE_RANKS in bpe_files()["path"]


def test_remembered_pieces_are_bounded_and_change_nothing(codec, monkeypatch):
    assert bpe.CACHE_PIECES <= 100_000                # twice in every worker
    monkeypatch.setattr(bpe, "CACHE_PIECES", 8)
    few = bpe.Codec(codec.ranks, P.PATTERN)
    texts = [" ".join(f"word{i} the {i * 7}" for i in range(k, k + 30)) for k in range(40)]
    got = [few.encode(t) for t in texts]
    assert len(few.cache) <= 8 and len(few.older) <= 8
    monkeypatch.undo()
    assert got == [codec.encode(t) for t in texts]
