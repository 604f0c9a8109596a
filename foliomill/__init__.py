"""foliomill: DataFrame operators for large document corpora and their records."""
