"""Numpy helpers against plain Python: words, tokens, coder, packing, URL grams."""

from __future__ import annotations

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tablekit.llm import base, idcoder, pack, tokens, url_filter, words
from tablekit.llm.queries import tokenizer_path

TEXTS = ["The cat THE cat", None, "", " \t\n", "É é a,b x1", "x", "中文 text ", "a\x0bb\x0cc", "one two  three\r\nfour"]


def test_words_match_a_regular_expression():
    rx = re.compile(rb"[^\x20\x09-\x0d]+")
    for limit in (1, 7, 1 << 20):
        seen, spelled = {}, {}
        at = 0
        for part in base.slices(pa.array(TEXTS), limit):
            h, first = words.words(part, words.BY_SPACE)
            for i in range(len(part)):
                want = rx.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (TEXTS[at] or "").encode()))
                got = h[first[i]:first[i + 1]].tolist()
                assert len(got) == len(want)
                for g, w in zip(got, want):
                    assert seen.setdefault(w, g) == g and spelled.setdefault(g, w) == w
                at += 1
        assert at == len(TEXTS)


def test_long_text_is_hashed_in_pieces():
    one = " ".join(str(i % 977) for i in range(500_000))
    part = next(base.slices(pa.array([one])))
    h, first = words.words(part, words.BY_LETTER)
    assert len(h) == 500_000 and (h[:977] == h[977:1954]).all() and len(np.unique(h)) == 977


@pytest.mark.parametrize("limit", [50, 5000])
def test_tokens_equal_whole_text_encoding(limit):
    rnd = random.Random(3)
    parts = ["a", "B", "é", "Ñ", " ", "  ", "\n", "\u00a0", "\u2003", "'", "'s", "'re", "1", "23", ".", ",!", "-", "😀",
             "中", "“", "×", "ß", "<|endoftext|>", "\t", "\r\n", "word", "\x1c", "\u0085"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(1500)] + ["", None]
    e = tokens.Encoder(tokenizer_path())
    at = 0
    for part in base.slices(pa.array(texts), limit):
        ids, first = e.encode(part)
        for i in range(len(part)):
            assert ids[first[i]:first[i + 1]].tolist() == e.tokenizer.encode(texts[at] or "", add_special_tokens=False).ids
            at += 1


@pytest.mark.parametrize("n", [0, 1, 2, 511, 512, 513, 3000, 40_000])
@pytest.mark.parametrize("high", [1, 2, 300, 50_257, 70_000, 2**31 - 1])
def test_coder_round_trip(n, high):
    ids = np.random.default_rng(n + high).integers(0, high, n).astype(np.uint32)
    assert (idcoder.decode(idcoder.encode(ids)) == ids).all()


def test_coder_learns_and_checks():
    ids = np.tile(np.arange(50, dtype=np.uint32), 200)
    raw = idcoder.encode(ids)
    assert len(raw) < len(ids)  # far below the two bytes of an id
    broken = bytearray(raw)
    broken[-40] ^= 0xFF
    with pytest.raises(ValueError):
        idcoder.decode(bytes(broken))
    with pytest.raises(ValueError):
        idcoder.decode(b"other" + raw[5:])


def test_coded_ids_are_smaller_than_simpler_codes():
    """All documents of sf0.01: below order-0 entropy and the table, and below zlib of 16-bit ids."""
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"])["text"].to_pylist()
    encode = tokens.Encoder(tokenizer_path()).tokenizer.encode_batch_fast
    ids = np.concatenate([np.array([*e.ids, 0], np.uint32) for e in encode([t or "" for t in texts], add_special_tokens=False)])
    raw = idcoder.encode(ids)
    found, n = np.unique(ids, return_counts=True)
    entropy = -(n * np.log2(n / len(ids))).sum() / 8
    assert (idcoder.decode(raw) == ids).all()
    assert len(raw) < min(entropy + len(idcoder._Table(found, n).pack()), len(zlib.compress(ids.astype("<u2").tobytes(), 6)))


def test_a_block_is_decoded_alone():
    """Blocks share the table only: a damaged block leaves the others readable."""
    ids = np.random.default_rng(2).integers(0, 300, 4 * idcoder.SHORTEST).astype(np.uint32)
    raw = bytearray(idcoder.encode(ids))
    raw[-3] ^= 0xFF  # in the last block's words
    with pytest.raises(ValueError, match="block 3"):
        idcoder.decode(bytes(raw))


def _cost(cuts, penalty, chosen):
    total = 0
    for a, b in itertools.pairwise(chosen):
        size = cuts[b] - cuts[a]
        if size > pack.LENGTH:
            return None
        total += penalty[b] + (pack.SHORT if size in pack.UNPADDED else pack.LENGTH - size)
    return total


def test_packing_is_optimal():
    rng = np.random.default_rng(5)
    for _ in range(40):
        m = int(rng.integers(2, 11))
        gaps = rng.choice([1, 100, 512, 700, 1024, 2048, 900], m)
        cuts = np.concatenate([[0], np.cumsum(gaps)])
        penalty = np.concatenate([[0], rng.choice([0, pack.SENTENCE_CUT], m)])
        best = min(c for k in range(m) for mid in itertools.combinations(range(1, m), k)
                   if (c := _cost(cuts, penalty, [0, *mid, m])) is not None)
        chosen = pack.windows(cuts, penalty)
        assert _cost(cuts, penalty, np.searchsorted(cuts, chosen).tolist()) == best


def test_hard_cuts_fill_long_gaps():
    cuts, penalty = pack.with_hard_cuts(np.array([0, 5000, 5100]), np.array([0, 0, 0]))
    assert cuts.tolist() == [0, 2048, 4096, 5000, 5100]
    assert penalty.tolist() == [0, pack.HARD_CUT, pack.HARD_CUT, 0, 0]


def test_url_model_is_a_distribution():
    rng = np.random.default_rng(1)
    counts = np.zeros(url_filter.SYMBOLS ** 4)
    counts[rng.integers(0, len(counts), 500)] = rng.integers(1, 9, 500)
    p = np.exp(url_filter.log_probabilities(counts)).reshape(-1, url_filter.SYMBOLS)
    assert np.allclose(p.sum(1), 1)


def test_url_grams_match_python():
    urls = [b"http://a.org/x1", b"", b"ab"]
    data = np.frombuffer(b"".join(urls), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(u) for u in urls])])
    code, begin = url_filter.grams(data, offs)
    ends = np.append(begin[1:], len(code))
    for u, a, b in zip(urls, begin, ends):
        sym = [0] * 3 + [int(url_filter._CLASS[c]) for c in u] + [0]
        want = [((sym[i] * 40 + sym[i + 1]) * 40 + sym[i + 2]) * 40 + sym[i + 3] for i in range(len(u) + 1)]
        assert code[a:b].tolist() == want


def test_crc_of_little_endian_ids():
    ids = np.array([1, 256, 50256], np.uint32)
    assert zlib.crc32(ids.astype("<u4").tobytes()) == zlib.crc32(b"\x01\0\0\0\0\x01\0\0\x50\xc4\0\0")
