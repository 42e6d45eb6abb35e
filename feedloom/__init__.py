"""feedloom: feeds into and out of Spark tables, as DataFrame operators."""

__version__ = "0.1.0"
