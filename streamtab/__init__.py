"""streamtab: stream-and-table analytics operators expressed as Spark DataFrame plans.

Every operator is a ``DataFrame -> DataFrame`` function.  Batch forms are exact
replays of the keyed/ordered semantics (checked against SQL oracles); streaming
forms live in :mod:`streamtab.streaming` and are checked against the batch forms.
"""

__version__ = "0.1.0"
