"""tramline — transit analytics (GTFS schedule + GTFS-RT punctuality) on Spark.

Everything is a DataFrame transform: column builders in ``functions``,
readers / writers and the driver-table stand-ins in ``sources``,
reusable relational steps in ``operators``, the user-facing answers in
``plans`` and the poll-file stream in ``streaming``.
"""

from tramline.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
