"""creditloom: loan-default feature, training and evaluation jobs on Spark DataFrames."""
