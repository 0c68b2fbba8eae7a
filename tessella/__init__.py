"""tessella: dataset-curation queries and operators for PySpark."""
