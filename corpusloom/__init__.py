"""Spark-first engine for large text corpora, their chunks and their vectors.

The core lives in ``functions``, ``operators``, ``sources``, ``streaming`` and
``plans``.  The subpackage ``llm`` holds the operators for training-data work;
nothing outside it imports it, so it can be left out.
"""

__version__ = "0.1.0"
