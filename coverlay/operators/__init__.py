"""DataFrame → DataFrame operators: grid joins, dissolve, adjacency, point lookups, line work, simplification."""
