"""Customer-risk features, profiling, scorecard statistics and scoring on Spark."""
