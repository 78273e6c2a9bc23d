"""newsdesk: news acquisition and catalogue upkeep as Spark DataFrame jobs.

Every operator is a function from DataFrames (and plain parameters such as
``now``) to DataFrames. Nothing is collected to the driver; the only Python
that runs per row lives in the HTML extraction pandas UDFs.
"""

from newsdesk.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
