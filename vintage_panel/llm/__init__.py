"""Operators that prepare documents for language-model training, as Spark jobs."""
