"""turnloom: DataFrame operators for time-coded conversational text on Spark."""

__version__ = "0.1.0"
