"""Dataset curation and model-answer evaluation as PySpark DataFrame operators."""

__version__ = "0.1.0"
