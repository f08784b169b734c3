"""quiltgraph: a PySpark engine that turns tables into a property graph and keeps it in sync."""
