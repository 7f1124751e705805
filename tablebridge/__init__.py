"""tablebridge: tables that live elsewhere, as Spark DataFrames."""

__version__ = "0.1.0"
