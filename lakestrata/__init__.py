"""Monthly extracts to a star schema, and the analysis on top, as Spark DataFrame jobs."""
