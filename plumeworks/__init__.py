"""Air-quality and wildfire-smoke analytics expressed as Spark DataFrame plans."""
