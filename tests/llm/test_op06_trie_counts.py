import math

import public_tokenizers
import pytest
from helpers import docs_frame, sample_docs

from fieldloom.llm import queries as Q
from fieldloom.llm import trie_counts
from fieldloom.llm.trie_counts import BYTE_PENALTY, MARK, Trie, piece_scores, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")


def viterbi(word, pieces, _known={}):  # noqa: B006
    if not _known:
        _known.update(byte=min(pieces.values()) - BYTE_PENALTY, longest=max(map(len, pieces)))
    byte, longest = _known["byte"], _known["longest"]
    best = [(0.0, 0)] + [None] * len(word)
    for i in range(1, len(word) + 1):
        n = len(word[i - 1].encode())
        options = [(best[i - 1][0] + n * byte, best[i - 1][1] + n)]
        options += [(best[j][0] + pieces[word[j:i]], best[j][1] + 1) for j in range(max(0, i - longest), i) if word[j:i] in pieces]
        best[i] = max(options, key=lambda o: (o[0], -o[1]))
    return best[-1]


def brute(rows, pieces):
    out, known = [], {}
    for i, t in rows:
        ws = [MARK + w for w in (t or "").split()]
        for w in ws:
            if w not in known:
                known[w] = viterbi(w, pieces) if len(w) < 3000 else None
        if any(known[w] is None for w in ws):
            continue
        out.append((i, len(ws), sum(known[w][1] for w in ws), sum(known[w][0] for w in ws)))
    return sorted(out, key=repr)


def same(got, want):
    ids = {w[0] for w in want}
    got = sorted((tuple(r) for r in got if r[0] in ids), key=repr)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(math.isclose(g[3], w[3], rel_tol=1e-9, abs_tol=1e-5) for g, w in zip(got, want, strict=True))


def test_awkward_rows(spark, monkeypatch):
    pieces = piece_scores(PATH)
    rows = sample_docs() + [(400, "unbelievable " + "ab" * 300), (401, "a b c"), (402, "\U0001f9ff͸")]
    got = token_counts(docs_frame(spark, rows), PATH).collect()
    assert len(got) == len(rows)
    same(got, brute(rows, pieces))


def test_trie_restarts_and_ties():
    t = Trie({"a": -1.0, "b": -1.0, "ab": -2.0, "aba": -5.0})
    assert t.look("ab") == (-2.0, 1)  # equal scores: fewer tokens
    assert t.look("abab") == (-4.0, 2)
    made = len(t.score)
    t.look("aba")
    assert len(t.score) == made  # every prefix was there already
    t.reset()
    assert t.look("abab") == (-4.0, 2)
    assert t.look("ab" * 200) == (-400.0, 200) and len(t.score) < trie_counts.LONG  # past LONG: scored outside


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, "x")]])
def test_tiny(spark, rows):
    got = token_counts(docs_frame(spark, rows), PATH).collect()
    assert len(got) == len(rows)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    same(Q.op6_token_counts(spark, sf).collect(), brute(rows, piece_scores(PATH)))
