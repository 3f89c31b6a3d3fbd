import random

import numpy as np

from spanlog.llm import substrings
from spanlog.llm.rindex import RunLengthIndex
from llm_fixtures import make_docs  # noqa: E402, F401


def brute_removed(texts, window=100):
    """Per text (in order), the mask of removed bytes."""
    seen, out = set(), []
    for b in texts:
        gone = np.zeros(len(b) + 1, int)
        for o in range(len(b) - window + 1):
            w = b[o:o + window]
            if w in seen:
                gone[o] += 1
                gone[o + window] -= 1
            seen.add(w)
        out.append(np.cumsum(gone)[:-1] > 0)
    return out


def test_index_finds_every_earlier_string():
    rng = random.Random(3)
    for depth in (1, 2, 3, 5, 8, 100):
        for _ in range(15):
            pool = [bytes(rng.choice(b"ab\0c") for _ in range(rng.randint(0, 2 * depth + 5))) for _ in range(6)]
            strings = [b"".join(rng.sample(pool, rng.randint(1, 3))) * rng.choice([1, 1, 3]) for _ in range(rng.randint(1, 10))]
            seen = set()
            for s, got in zip(strings, RunLengthIndex(strings, depth).repeats(), strict=True):
                want = []
                for o in range(len(s) - depth + 1):
                    want += [o] * (s[o:o + depth] in seen)
                    seen.add(s[o:o + depth])
                assert got.tolist() == want


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    core = rng.integers(97, 123, 160, dtype=np.uint8)
    for gram in substrings.GRAMS:
        of = []
        for _ in range(2):
            b = np.concatenate([rng.integers(97, 123, rng.integers(0, 300), dtype=np.uint8), core, rng.integers(97, 123, 50, dtype=np.uint8)])
            at = bytes(b).index(bytes(core))
            a, _, start, count = substrings.slices(b, gram)
            assert start[0] == 0 and count.sum() == len(b) - 99
            of.append(np.repeat(a, count)[at:at + 61])
        assert (of[0] == of[1]).all()


def rows_for_test():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(60)) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(3)]
        rows.append((i * 3, f"{parts[0]} {rng.choice(passages)[rng.randint(0, 50):]} {parts[1]} {rng.choice(passages)} {parts[2]}", "en", "s"))
    rows += [(1000 + i, passages[0], "en", "s") for i in range(30)]
    rows += [(2000, "ab" * 4000, "en", "s"), (2001, "x" * 99, "en", "s"), (2002, "x" * 100, "en", "s"), (2003, "x" * 101, "en", "s"), (2004, None, None, None),
             (2005, "", "en", "s"), (2006, "0123456789" * 14, "en", "s")]
    return rows


def compare(got, rows):
    want = {}
    for (i, text, *_), gone in zip(rows, brute_removed([(t or "").encode() for _, t, *_ in rows]), strict=True):
        b = np.frombuffer((text or "").encode(), np.uint8)
        spans = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        want[i] = (len(b), int(gone.sum()), int((spans == 1).sum()), b[~gone].tobytes(),
                   list(zip(np.nonzero(spans == 1)[0].tolist(), np.nonzero(spans == -1)[0].tolist(), strict=True)))
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in got} == want


def test_removal_equals_brute_force(make_docs):
    rows = rows_for_test()
    compare(substrings.deduplicate(make_docs(rows)).collect(), rows)


def test_hot_anchors_are_cut_again(make_docs, monkeypatch):
    monkeypatch.setattr(substrings, "ROWS_AT_ONCE", 40)
    monkeypatch.setattr(substrings, "HOT_TIMES", 1)
    rows = rows_for_test()
    compare(substrings.deduplicate(make_docs(rows, clash=False), index_bytes=400).collect(), rows)


def test_repeated_and_null_ids(make_docs):
    text = "a passage that is longer than one hundred bytes, so that it would be removed wherever it is found a second time"
    rows = [(None, text, "en", "s"), (4, text, "en", "s"), (4, text, "en", "s"), (5, "short", "en", "s"), (5, None, "en", "s")]
    got = substrings.deduplicate(make_docs(rows)).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_removed"]) for r in got) == [(-1, 0), (4, len(text)), (4, len(text)), (5, 0), (5, 0)]
    assert substrings.deduplicate(make_docs([])).count() == 0
