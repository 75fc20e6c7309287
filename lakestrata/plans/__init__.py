"""The layers: silver tables, the star schema, the analysis queries and the measures."""
