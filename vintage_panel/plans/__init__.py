"""End-to-end builds and the catalogue of checked queries."""
