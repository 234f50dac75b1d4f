"""Street corners scored for pedestrian risk, and training-data operators, on Spark."""
