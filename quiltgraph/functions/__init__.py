"""Names, graph types, property values, schema strategies, timestamps."""
