"""Reading the monthly text extracts, and reading and writing the layers."""
