import random

from llm_brute import components

from orderflow.llm.components import connected_components


def test_paths_stars_random_links_and_loops(llm_spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(1, 70)] + [(1000, 1000 + i) for i in range(1, 300)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)] + [(5000, 5000), (6000, 6001), (6001, 6000)]
    rng.shuffle(links)
    df = llm_spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == components({n for e in links for n in e}, links)
    assert connected_components(df.limit(0)).count() == 0
