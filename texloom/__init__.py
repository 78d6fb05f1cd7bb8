"""Spark-first analytics over collections of scientific LaTeX documents."""
