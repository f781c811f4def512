"""corpusloom: building, linking, validating and selecting text corpora on Spark."""
