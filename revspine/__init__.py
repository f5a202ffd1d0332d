"""revspine: recurring-revenue analytics on Spark."""
