"""skuweave: product identity and product voice analytics as PySpark jobs."""
