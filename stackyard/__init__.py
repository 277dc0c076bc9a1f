"""stackyard: Spark-native tabular features, out-of-fold stacking and blending.

Every public operator takes and returns a ``DataFrame`` (or a small fitted
object holding a ``DataFrame``). Work is expressed with built-in column
expressions, aggregates, windows and joins so Catalyst can prune, push down
and code-generate it; Spark ML is used at the model boundary only.
"""

__version__ = "0.1.0"
