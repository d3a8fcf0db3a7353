import random

from layerwell.llm.components import connected


def test_components_of_chains_stars_and_noise(spark):
    random.seed(8)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    noise = [(random.randint(2000, 2300), random.randint(2000, 2300)) for _ in range(150)]
    links = chain + star + noise + [(7, 7), chain[3], chain[3][::-1]]
    random.shuffle(links)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected(spark.createDataFrame(links, "a long, b long")).collect()}
    real = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in real}


def test_no_links(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []
