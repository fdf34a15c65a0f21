"""factloom: provenance-tracked text analytics and training-data operators, expressed as Spark plans."""

__version__ = "0.1.0"
