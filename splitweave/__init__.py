"""Split very wide customer snapshots into narrow shared tables, and check them, on Spark."""
