"""Moved directories: the best partner against brute force, names that all directories hold, few pairs met."""

import random

from spanlog.operators import moves as J

LOG = "seq long, op string, path string"


def _log(new: dict, old: dict) -> list[tuple]:
    """New directories before their files, deleted ones after theirs, in the order given."""
    rows = [("new_dir", d) for d in new] + [("new_file", d + f) for d, fs in new.items() for f in fs]
    rows += [("del_file", d + f) for d, fs in old.items() for f in fs] + [("del_dir", d) for d in old]
    return [(i, op, path) for i, (op, path) in enumerate(rows)]


def _brute(new: dict, old: dict, min_pct: int = 10) -> set:
    out = set()
    for d, fs in new.items():
        best = max(((len(fs & gs), -i, o) for i, (o, gs) in enumerate(old.items())), default=(0, 0, ""))
        if best[0] >= 1 and best[0] * 100 >= len(fs) * min_pct:
            out.add((d, best[2], best[0]))
    return out


def _got(spark, new, old):
    rows = J.best_move(spark.createDataFrame(_log(new, old), LOG)).select("new_dir", "old_dir", "matches").collect()
    return {(r.new_dir, r.old_dir, r.matches) for r in rows}


def _random(seed, skewed):
    r = random.Random(seed)
    names = [f"f{i}" for i in range(30)]

    def one():
        k = r.randrange(1, 9)
        fs = {names[min(29, int(r.expovariate(0.25)))] for _ in range(k)} if skewed else set(r.sample(names, k))
        return fs | ({"index"} if r.random() < 0.7 else set())
    old = {f"old{i}/": one() for i in r.sample(range(60), 60)}
    new = {f"new{i}/": (set(r.choice(list(old.values()))) if r.random() < 0.4 else one()) for i in range(60)}
    return new, old


def test_best_partners_equal_brute_force(spark):
    for seed, skewed in ((1, False), (2, True)):
        new, old = _random(seed, skewed)
        assert _got(spark, new, old) == _brute(new, old)


def test_ties_supersets_and_strangers(spark):
    old = {"o1/": {"a", "b", "c"}, "o2/": {"a", "b"}, "o3/": {"a", "b"}, "o4/": {"z"}}
    new = {"n1/": {"a", "b"}, "n2/": {"a", "b", "c", "d"}, "n3/": {"q"}, "n4/": {"z", "a"}, "n5/": set()}
    assert _got(spark, new, old) == {("n1/", "o1/", 2), ("n2/", "o1/", 3), ("n4/", "o1/", 1)} == _brute(new, old)


def test_no_changes(spark):
    assert J.best_move(spark.createDataFrame([], LOG)).count() == 0


def test_a_name_in_every_directory_makes_no_product(spark, monkeypatch):
    """Three names in 2,000 directories a side (4,000,000 pairs share one): as many pairs are counted as there are directories, or so."""
    n = 2000
    old = {f"o{i}/": {"index", "style", "logo", f"own{i}"} for i in range(n)}
    new = {f"n{i}/": {"index", "style", "logo", f"own{(i * 7) % n}"} for i in range(n)}
    counted = []

    def spy(pairs, a, b, own=J._overlaps):
        counted.append(pairs.count())
        return own(pairs, a, b)
    monkeypatch.setattr(J, "_overlaps", spy)
    got = _got(spark, new, old)
    assert got == {(f"n{i}/", f"o{(i * 7) % n}/", 4) for i in range(n)}
    assert sum(counted) <= 2 * n + 10


def test_copies_of_one_set_are_settled_once(spark, monkeypatch):
    counted = []

    def spy(pairs, a, b, own=J._overlaps):
        counted.append(pairs.count())
        return own(pairs, a, b)
    monkeypatch.setattr(J, "_overlaps", spy)
    old, new = ({f"{side}{i}/": {"index", "style"} for i in range(1500)} for side in "on")
    assert _got(spark, new, old) == {(d, "o0/", 2) for d in new}
    assert sum(counted) <= 2
