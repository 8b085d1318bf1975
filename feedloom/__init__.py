"""Multi-key total ordering of a dirty, partitioned record feed on Spark."""
