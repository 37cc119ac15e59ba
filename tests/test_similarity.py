import itertools

import numpy as np
import pytest

from rostrum.operators import similarity as sim


def test_block_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    members = [f"m{i:02d}" for i in range(23)]
    terms = [f"t{j}" for j in range(12)]
    rows, vec = [], {}
    for m in members:
        v = rng.random(len(terms)) * (rng.random(len(terms)) < 0.4)
        if not v.any():
            v[0] = 1.0
        v = v / np.linalg.norm(v)
        vec[m] = v
        rows += [(m, terms[j], float(v[j])) for j in np.nonzero(v)[0]]
    w = spark.createDataFrame(rows, "member_name string, term string, weight double")
    got = {(r["member1"], r["member2"]): r["similarity"] for r in sim.member_pairs(w, members_per_block=5).collect()}
    exp = {(a, b): float(vec[a] @ vec[b]) for a, b in itertools.combinations(members, 2) if vec[a] @ vec[b] > 0}
    assert set(got) == set(exp)
    assert max(abs(got[k] - exp[k]) for k in exp) < 1e-12
    top = sim.top_pairs(w, k=7, members_per_block=5).orderBy("rank").collect()
    ranked = sorted(exp.items(), key=lambda kv: (-round(kv[1], 9), kv[0]))[:7]
    assert [(r["member1"], r["member2"]) for r in top] == [k for k, _ in ranked]


def clustered(spark, n=60, clusters=6, terms=300, seed=5):
    """Unit vectors around a few centres, as rows and as a matrix."""
    rng = np.random.default_rng(seed)
    centres = rng.exponential(1, (clusters, terms)) * (rng.random((clusters, terms)) < 0.3)
    x = centres[np.arange(n) % clusters] * rng.uniform(0.7, 1.3, (n, terms)) * (rng.random((n, terms)) < 0.9)
    x[n - 1] = x[0]  # a copy
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(f"m{i:03d}", f"t{j:03d}", float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    return spark.createDataFrame([*rows, (None, "t000", 1.0)], "member_name string, term string, weight double"), x


@pytest.mark.parametrize("leading", [1, 40, 1024])
@pytest.mark.parametrize("per_block", [7, 1000])
def test_bounds_hold_and_prune(spark, leading, per_block):
    w, x = clustered(spark)
    top = sim.top_pairs(w, k=9, members_per_block=per_block, leading=leading).orderBy("rank").collect()
    pairs = sorted((-round(float(x[i] @ x[j]), 9), f"m{i:03d}", f"m{j:03d}") for i, j in itertools.combinations(range(len(x)), 2))
    assert [(-round(r["similarity"], 9), r["member1"], r["member2"]) for r in top] == pairs[:9]
    vec = sim.member_vectors(w)
    alive = sim.pair_bounds(vec, 9, sim._blocks(vec, per_block), leading).collect()
    for r in alive:
        s = float(x[int(r["member1"][1:])] @ x[int(r["member2"][1:])])
        assert r["low"] - 1e-9 <= s <= r["high"] + 1e-9
    assert {p[1:] for p in pairs[:9]} <= {(r["member1"], r["member2"]) for r in alive}
    if leading == 40:
        assert len(alive) < 0.4 * len(pairs)
    if leading == 1024:  # whole vectors: bounds are exact
        assert len(alive) < 12


def test_few_members(spark):
    w, _ = clustered(spark, n=3, clusters=3)
    assert len(sim.top_pairs(w, k=10).collect()) == 3
    assert sim.top_pairs(w.where("member_name = 'm001'"), k=10).count() == 0
    assert sim.top_pairs(w.limit(0), k=10).count() == 0


def test_member_parties(spark):
    df = spark.createDataFrame([("a", "P2"), ("a", "P1"), ("a", "P1"), ("b", None)], "member_name string, political_party string")
    got = {r["member"]: r["parties"] for r in sim.member_parties(df).collect()}
    assert got == {"a": "P1, P2", "b": "Unknown"}
