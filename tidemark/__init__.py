"""Point-in-time feature engineering, label building and modelling on Spark DataFrames."""
