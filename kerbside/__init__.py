"""Road-accident severity analytics as DataFrame operators."""

__version__ = "0.1.0"
