"""Fleet health analytics on Spark: clean, label, featurise, model, evaluate, report."""
