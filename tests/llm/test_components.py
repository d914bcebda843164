import random

import pytest

from verdance.llm import components


@pytest.mark.parametrize("hub", [2, 65_536])
def test_components_are_brute_force(spark, tmp_path, hub):
    """Chains, stars and a clique, with and without nodes that count as hubs."""
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 20)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 230) for i in range(20)] + [(300 + i, 300 + j) for i in range(6) for j in range(i)]
    links += [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)] + [(7, 7)]
    root = {n: n for e in links for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "u long, v long"), hub).collect()}
    alone = {n for a, b in links for n in (a, b) if a == b} - {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: find(n) for n in root if n not in alone}
    assert components.components(spark.createDataFrame([], "u long, v long"), hub).count() == 0
