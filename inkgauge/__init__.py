"""inkgauge: labelled-text-corpus analytics as PySpark DataFrame operators."""
