"""alertflow: PySpark operators for preparing and classifying astronomical alert streams.

Subpackages: ``sources`` and ``sinks`` (I/O), ``functions`` (column
expressions), ``operators`` (DataFrame operators), ``plans`` (composed
flows), ``streaming`` (Structured Streaming jobs).
"""

__version__ = "0.1.0"
