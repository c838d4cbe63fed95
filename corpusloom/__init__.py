"""corpusloom: Spark-first curation of very large text corpora."""
