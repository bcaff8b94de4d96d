"""Ego nets that one group holds are worked off there; larger ones go by rounds."""

import random

from graphmill.operators import components
from graphmill.operators.components import connected_components


def test_small_nets_take_no_rounds(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(g, a, b) for g in range(6) for a, b in [(rng.randrange(40), rng.randrange(40)) for _ in range(5 * g)]]
    rows += [(0, 7, 7), (2, 90, None), (2, None, 91), (3, None, None), (9, None, 5), (None, 4, 3), (None, 4, None)]
    nets = spark.createDataFrame(rows, "ego_id long, src long, dst long")

    def got():
        return sorted((tuple(r) for r in components.ego_components(nets).collect()), key=str)

    want = sorted((tuple(r) for r in connected_components(nets, keys=["ego_id"]).collect()), key=str)
    with monkeypatch.context() as m:
        m.setattr(components, "connected_components", None)
        assert got() == want
    monkeypatch.setattr(components, "NET_EDGES", 12)  # some by rounds, some in groups
    assert got() == want
