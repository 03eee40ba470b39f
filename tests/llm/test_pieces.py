"""Pieces of text are found by a hash, and told apart by their bytes."""

from __future__ import annotations

import numpy as np
import pytest

from tablekit.llm import tokens
from tablekit.llm.base import Texts
from tablekit.llm.queries import tokenizer_path


@pytest.mark.parametrize("bits", [0, 3, 64])
def test_pieces_with_equal_hashes_keep_their_ids(monkeypatch, bits):
    full = tokens.hash_spans
    monkeypatch.setattr(tokens, "hash_spans", lambda *a: full(*a) & np.uint64((1 << bits) - 1))
    monkeypatch.setattr(tokens, "MEMORY", 60)
    coder, rng = tokens.Encoder(tokenizer_path()), np.random.default_rng(3)
    for _ in range(6):
        texts = [" ".join(f"word{i}" if i % 3 else f"It's-{i}!\n" for i in rng.integers(0, 60, n)) for n in (0, 1, 30, 80)]
        data = [x.encode() for x in texts]
        offs = np.cumsum([0, *map(len, data)])
        ids, first = coder.encode(Texts(np.frombuffer(b"".join(data), np.uint8), offs, slice(0, len(data))))
        assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == [
            coder.tokenizer.encode(x, add_special_tokens=False).ids for x in texts]
