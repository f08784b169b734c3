"""Relational operators: projection to nodes and edges, folding, endpoint joins, upserts, deletes, soft deletes and watermarks."""
