"""leadlens: lead-funnel and marketing analytics written as Spark DataFrame plans."""

__version__ = "0.1.0"
