"""Company-record integration on Spark: extract, link, unify."""

__version__ = "0.1.0"
