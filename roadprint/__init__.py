"""roadprint: trajectory analytics and per-entity trip classification on Spark.

Data model: one long ``steps`` table, one row per recorded point, with the
columns ``driver``, ``trip``, ``step``, ``x``, ``y`` (plus an optional
``label``).  Every operator takes and returns a DataFrame and stays lazy;
Catalyst plans the work.
"""

from roadprint.session import get_session, shared_dir

KEYS = ["driver", "trip"]

__all__ = ["KEYS", "get_session", "shared_dir"]
