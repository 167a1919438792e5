"""Corpus analytics on PySpark: DataFrame-to-DataFrame operators over document archives."""
