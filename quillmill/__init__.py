"""quillmill: a Spark-native engine for evidence curation over literature tables."""
