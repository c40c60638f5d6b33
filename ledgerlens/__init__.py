"""ledgerlens: cleaning, labelling and watching transaction texts on Spark."""

__version__ = "0.1.0"
