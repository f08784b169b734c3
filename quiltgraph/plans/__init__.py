"""The graph store, runs, scaffold, preview, control tables, statement text and the query catalogue."""
