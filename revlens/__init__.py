"""revlens: review analytics on Spark.

Turns semi-structured listing data into review rows, scores the reviews
through a pluggable model backend in distributed batches, splits data
into exact, repeatable dev/test sets, picks the best prompt by mean
absolute deviation and compares it with MLlib text classifiers.

Every stage is a DataFrame plan; Python workers are used only where a
value has to be parsed as a Python literal or sent to a model.
"""

from revlens.session import get_session, stage_root

__all__ = ["get_session", "stage_root"]
__version__ = "0.1.0"
