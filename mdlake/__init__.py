"""Market-data lake jobs on Spark: clean, merge, upsert, plan and retain daily and intraday tables."""
