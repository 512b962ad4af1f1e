import hashlib
import random

import pytest

from tidewatch.llm.sentencepiece_codec import codec, default_model, encode_documents


@pytest.fixture(scope="module")
def tool():
    return codec(default_model())


def test_same_ids_as_the_library(tool):
    rng = random.Random(4)
    pieces = list(tool.id_of)
    odd = ["  ", "▁", "\n", "\x00", " ", "ｆ", "\U0001d54f", "é", "é", "<s>", "<0x41>", "</s>", "﻿"]
    for _ in range(3000):
        text = "".join(
            rng.choice([rng.choice(pieces), rng.choice(odd), rng.choice("aeiou xyz.,0"), chr(rng.randrange(1, 0xD7FF))])
            for _ in range(rng.randrange(10))
        )
        assert tool.encode(text) == tool.library.encode(text, add_eos=True)


def test_long_runs(tool):
    for text in ("ab" * 3000, "a" * 5000, " " * 1000, "é́" * 800):
        assert tool.encode(text) == tool.library.encode(text, add_eos=True)


def test_backtracking_takes_pieces_back(tool):
    text = "▁thereinafterwardsly"
    assert tool.backtrack(text) == tool.merged(text)


def test_documents(docs, no_docs, tool):
    rows = encode_documents(docs, with_ids=True).collect()
    assert len(rows) == docs.count()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    for r in rows:
        assert any(list(r.ids) == tool.library.encode(t, add_eos=True) for t in texts[r.doc_id])
        assert r.n_tokens == len(r.ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tool.library.decode(list(r.ids)).encode()).hexdigest()
    assert encode_documents(no_docs).count() == 0
