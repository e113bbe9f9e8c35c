import random

import pytest

from tidecall.llm.common import Scratch
from tidecall.llm.components import connected_components


@pytest.mark.parametrize("links", [[], [(i, i + 1) for i in range(70)], [(0, i) for i in range(1, 50)], "random"])
def test_equals_union_find(spark, links):
    if links == "random":
        r = random.Random(5)
        links = [(r.randrange(300), r.randrange(300)) for _ in range(200)]
    label = {x: x for link in links for x in link}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        label[b] = a
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.label for r in connected_components(df, Scratch(spark, "t")).collect()}
    touched = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in touched}
