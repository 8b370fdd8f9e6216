"""Components against a union-find in Python."""

import numpy as np
import pytest

from gazetta.llm import common, components


def labels(pairs):
    parent = {x: x for p in pairs for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in pairs:
        lo, hi = sorted((find(x), find(y)))
        parent[hi] = lo
    return {x: find(x) for x in parent}


rng = np.random.default_rng(3)
GRAPHS = {
    "path": [(i, i + 1) for i in range(60)],
    "star": [(5, i) for i in range(50) if i != 5],
    "clique": [(i, j) for i in range(12) for j in range(12) if i != j],
    "random": [(int(x), int(y)) for x, y in rng.integers(-500, 500, (400, 2)) if x != y],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    pairs = GRAPHS[name]
    df = spark.createDataFrame([*pairs, *pairs[:3], (7, 7), (None, 3), (3, None)], "x long, y long")
    got = components.connected_components(df, "x", "y").collect()
    assert len(got) == len({r["v"] for r in got}) and {r["v"]: r["label"] for r in got} == labels(pairs)


def test_no_links(spark):
    assert components.connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_scratch_is_cleared(spark):
    path = common.scratch_root(spark)
    kept = common.materialise(spark.range(3))
    assert kept.count() == 3 and path.startswith("file://")
    common.clear_scratch(spark)
    with pytest.raises(Exception, match="(?i)exist"):
        kept.count()
