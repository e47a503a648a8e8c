"""footfall: visitor-flow analytics on mobile signalling data, as Spark DataFrame operators."""

__version__ = "0.1.0"
