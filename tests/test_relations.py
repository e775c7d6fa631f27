"""Multi-hop relations against a walk level by level."""

import random
from collections import Counter

import pytest

from brightweir.operators import relations


def walked(steps, starts, max_hops):
    """(start, node, hops, n_paths) by counting ways level by level."""
    after = {}
    for src, dst in set(steps):
        if src is not None and dst is not None:
            after.setdefault(src, []).append(dst)
    out = set()
    for start in set(starts) - {None}:
        seen, level = {start}, Counter({start: 1})
        for hop in range(1, max_hops + 1):
            ways = Counter()
            for node, n in level.items():
                for dst in after.get(node, []):
                    ways[dst] += n
            level = Counter({node: n for node, n in ways.items() if node not in seen})
            seen |= set(level)
            out |= {(start, node, hop, n) for node, n in level.items()}
    return out


def reached(spark, steps, starts, max_hops):
    steps = spark.createDataFrame(steps, "src string, dst string")
    found = relations.reach(steps, spark.createDataFrame([(s,) for s in starts], "node string"), max_hops)
    rows = [tuple(r) for r in found.select("start", "node", "hops", "n_paths").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("most", [10_000, 3])
def test_reach_is_that_of_a_walk(spark, monkeypatch, most):
    """With a hub, cycles, loops, repeated and null steps; also where the hub's steps are dealt to parts."""
    monkeypatch.setattr(relations, "EDGES_PER_PART", most)
    random.seed(6)
    steps = [(f"n{random.randint(0, 30)}", f"n{random.randint(0, 30)}") for _ in range(60)]
    steps += [("hub", f"n{i}") for i in range(25)] + [(f"n{i}", "hub") for i in range(0, 25, 3)] + steps[:10]
    steps += [("n1", "n1"), (None, "n2"), ("n3", None)]
    starts = ["n0", "n1", "hub", "hub", None, "nowhere"]
    assert reached(spark, steps, starts, 4) == walked(steps, starts, 4)


def test_ways_are_counted_and_ends_are_met(spark):
    steps = [("a", "b1"), ("a", "b2"), ("b1", "c"), ("b2", "c"), ("c", "a"), ("c", "d")]
    assert reached(spark, steps, ["a"], 10) == {("a", "b1", 1, 1), ("a", "b2", 1, 1), ("a", "c", 2, 2), ("a", "d", 3, 2)}
    assert reached(spark, steps, ["d"], 3) == set()
    assert reached(spark, [], ["a"], 3) == set()


def test_steps_both_ways_keep_kinds_apart(spark):
    edges = spark.createDataFrame(
        [("x", "HIRES", "eng", 1), ("y", "HIRES", "eng", 2), ("y", "PRODUCES", "x", 1)], "vendor string, relation string, target string, weight long"
    )
    steps = {tuple(r) for r in relations.both_ways(edges, ["HIRES"]).collect()}
    assert steps == {("vendor:x", "hires:eng"), ("vendor:y", "hires:eng"), ("hires:eng", "vendor:x"), ("hires:eng", "vendor:y"), ("vendor:y", "produces:x")}
