"""DataFrame operators on edges, adjacency records, ranks and their history."""
