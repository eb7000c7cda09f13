"""stratiform: customer segmentation and profiling on Spark DataFrames."""
