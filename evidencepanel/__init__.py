"""Panel data with provenance on Spark: merge, check, score, extract, deliver."""

__version__ = "0.1.0"
