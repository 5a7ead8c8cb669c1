"""Lexispark: dictionary text to a quality-checked parallel corpus, as Spark DataFrame operators."""
