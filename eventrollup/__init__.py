"""eventrollup: count events over calendar buckets with Spark.

Batch layer (landing JSON -> master Parquet -> multi-grain view), speed layer
(Structured Streaming partial counts) and serving (range cover over both views)
are all plain DataFrame-to-DataFrame functions.
"""

from eventrollup.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
