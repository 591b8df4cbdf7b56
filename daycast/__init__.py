"""daycast — time-series rollup, feature and forecasting jobs on Spark.

Every public function takes and returns Spark DataFrames (or fitted Spark ML
models); nothing is collected to the driver except bounded one-row results
(date bounds, group-size checks, metric values).
"""

from daycast.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
