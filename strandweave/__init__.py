"""strandweave: alignment-hit, interval and taxonomy analytics as lazy DataFrame operators."""

__version__ = "0.1.0"
