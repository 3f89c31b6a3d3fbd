import random

import pytest
import sentencepiece

from spanlog.llm import pieces
from spanlog.llm.queries import QUERIES
from llm_fixtures import make_docs  # noqa: E402, F401


@pytest.fixture(scope="module")
def lex():
    return pieces.load()


def brute_scores(text, n, lex):
    """The n best scores over the whole lattice, without cutting it into chunks."""
    s = pieces.SPACE + text.replace(" ", pieces.SPACE) if text else ""
    best = [[0]]
    for e in range(1, len(s) + 1):
        own = []
        for b in range(max(0, e - lex.longest), e):
            w = lex.score.get(s[b:e])
            if w is None and b == e - 1:
                w = lex.byte_score * len(s[b].encode())
            if w is not None:
                own += [v + w for v in best[b]]
        best.append(sorted(own, reverse=True)[:n])
    return best[-1]


def test_n_best_equals_brute_force_and_decodes(lex):
    rng = random.Random(6)
    texts = ["", " ", "a", "Hello world", "  two  spaces ", "ñandú\nçaé der\n\nThe 日本語 x", "the " * 30, "ab" * 60, "\n", "🦊🦊", "\x00\x01", "erst erst erst"]
    texts += ["".join(rng.choice("abcderst  \nñß漢") for _ in range(rng.randint(1, 70))) for _ in range(200)]
    encoder = pieces.Encoder(lex, 4, cache=100)
    for text, found in zip(texts, encoder.encode(texts), strict=True):
        assert [s for s, _ in found] == brute_scores(text, 4, lex)
        assert len({tuple(i.tolist()) for _, i in found}) == len(found)
        assert all(pieces.decode_ids(i.tolist(), lex) == text for _, i in found)
    again = encoder.encode(texts[:20])
    assert [[s for s, _ in f] for f in again] == [brute_scores(t, 4, lex) for t in texts[:20]]


def test_decoding_agrees_with_the_library(lex):
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for text in ["Hello world", "ñandú çaé\n日本語", " a  b "]:
        assert pieces.decode_ids(sp.encode(text), lex) == sp.decode(sp.encode(text)) == text


def test_encode_and_decode_frames(make_docs):
    rows = [(1, "the cat", "en", "s"), (2, None, "en", "s"), (3, "", None, None), (None, "the cat", "en", "s"), (4, "long " * 20_000, "en", "s"), (4, "x" * 3000, "en", "s")]
    out = pieces.encode(make_docs(rows), keep=("doc_id", "pieces", "score"), n=2)
    got = out.collect()
    by = {(r["doc_id"], r["pieces"] and len(r["pieces"][0]["ids"]) > 2000): r["pieces"] for r in got}
    assert by[2, None] is None and [list(p["ids"]) for p in by[3, False]] == [[]] and by[1, False] == by[None, False]
    texts = pieces.decode(out.selectExpr("doc_id", "get(pieces, 0).ids AS ids", "'?' AS text"), "ids", keep=("doc_id", "text")).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in texts) == sorted((i or 0, t or "") for i, t, *_ in rows)
    assert pieces.encode(make_docs([])).count() == 0


def test_query_round_trip(spark):
    out = QUERIES["op5_sentencepiece"](spark, "/root/testdata/sf0.01").collect()
    assert len(out) == 1000 and all(r["exact"] and r["n_best"] >= 1 for r in out)
