"""Alignment of two tokenizers against whole-text encoding and a byte-range brute force."""

from __future__ import annotations

import collections
import hashlib

import pytest
import sentencepiece
from tokenizers import Tokenizer

from tablekit.llm import queries, token_align
from tablekit.llm.token_align import Aligner, alignment, token_groups

A, B = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
ODD = [None, "", " ", "  lead", "trail  ", "a  b   c", "x▁y", "<|endoftext|> hi <s> </s> <unk>", "\x00a 　 b",
       "a;\r\nb);\r\n\r\n c\t\td\x0b\x0c e", "日本語 テキスト 🎉🎉 é́ ﬁ", "I'm don't '' 's  'll", "\xa0x \xa0 y",
       "if (x) {\r\n  return;\r}\r\n", "    z", "tab\t \tx  ", "xxxx" * 3000, "\n\n\n", "\r", "a", "the end", "the end",
       " ".join(f"w{i * 7919 % 5000}" for i in range(30_000))]


def brute(rows):
    """All pairs of token byte ranges near each other, on whole-text ids."""
    a_tok = Tokenizer.from_file(A)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=B)
    tool = Aligner(A, B)

    def spans(ids, table):
        out, at = [], 0
        for i in ids:
            out.append((at, at + len(table[i]), i))
            at += len(table[i])
        return out
    count, per = collections.Counter(), []
    for doc_id, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text, num_threads=1) if text else []
        whole = (" " + text).encode() if text else b""
        if not text or any(b"".join(t[i] for i in x) != whole for x, t in ((a, tool.a_bytes), (b, tool.b_bytes))):
            per.append((doc_id, 0, 0, 0, [], ""))
            continue
        a, b = spans(a, tool.a_bytes), spans(b, tool.b_bytes)
        ends = sorted({x[1] for x in a} & {x[1] for x in b})
        groups, links, i, j = [], [], 0, 0
        for end in ends:
            x, y = i, j
            while x < len(a) and a[x][1] <= end:
                x += 1
            while y < len(b) and b[y][1] <= end:
                y += 1
            groups.append(",".join(str(t[2]) for t in a[i:x]) + "|" + ",".join(str(t[2]) for t in b[j:y]))
            links += [(p[2], q[2]) for p in a[i:x] for q in b[j:y] if p[0] < q[1] and q[0] < p[1]]
            i, j = x, y
        count.update(links)
        per.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return {(i, na, nb, ng, len(links), sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if text else "") for i, na, nb, ng, links, text in per}, \
        {(i, text) for i, *_, text in per}


@pytest.fixture(scope="module")
def rows():
    return list(enumerate(ODD)) + [(None, "no id"), (3, "a second row of an id")]


def test_alignment_matches_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "doc_id AS id", "'x' AS chunk", "1 AS n_a", "'y' AS groups", "2 AS count")
    want, groups = brute(rows)
    for parts in (1, 7):
        got = alignment(docs.repartition(parts), A, B)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        found = [tuple(r) for r in got.collect()]
        assert set(found) == want and len(found) == len(rows)
    assert {tuple(r) for r in token_groups(docs, A, B).collect()} == groups
    assert alignment(docs.limit(0), A, B).count() == 0


def test_pieces_forgotten_and_whole_texts(spark, rows, monkeypatch):
    """A small memory, small calls and no cuts at all give the same groups."""
    texts = [t for _, t in rows]
    _, groups = brute(rows)
    want = [(g or None) for _, g in sorted(groups, key=lambda x: (x[0] is None, x[0]))]
    import pyarrow as pa
    from tablekit.llm.base import slices

    def found(tool, limit):
        out = []
        for part in slices(pa.array(texts, pa.string()), limit):
            out += [t and t.decode() for t in tool.group_texts(*tool.pieces(part))]
        return out
    monkeypatch.setattr(token_align, "MEMORY", 20)
    monkeypatch.setattr(token_align, "CALL_BYTES", 8)
    small = found(Aligner(A, B), 16)
    whole = Aligner(A, B)
    whole.starts[:] = False
    assert sorted(map(str, small)) == sorted(map(str, found(whole, 1 << 20))) == sorted(map(str, want))


def test_query_matches_brute_force(spark):
    docs = queries.table(spark, "/root/testdata/sf0.001", "documents")
    got = {tuple(r) for r in queries.REGISTRY["op11_token_align"](spark, "/root/testdata/sf0.001").collect()}
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])[0]
