"""acervo: a document-analytics engine for administrative circulars, built on PySpark DataFrames."""

__version__ = "0.1.0"
