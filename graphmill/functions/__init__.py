"""Graph primitives shared by the operators: edge-table shaping, neighbour
aggregation, and lineage-cutting state for iterative jobs."""

from graphmill.functions.graph import (  # noqa: F401
    adjacency, aggregate_messages, canonical, degrees, edge_table, make_graph, merge_edges,
    simple_undirected, symmetrize, triplets, vertices_of,
)
from graphmill.functions.state import StateStore  # noqa: F401
