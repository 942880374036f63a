"""tagloom: table jobs for building, cleaning and judging text-classification data on Spark."""
