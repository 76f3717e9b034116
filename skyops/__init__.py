"""skyops: catalog, log, metric, config, health-check and image analytics on Spark DataFrames."""

from skyops.session import prepare, scratch_dir

__all__ = ["prepare", "scratch_dir"]
