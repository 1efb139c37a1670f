"""Bronze, silver, gold and quality plans: DataFrames and parameters in, DataFrames out."""
