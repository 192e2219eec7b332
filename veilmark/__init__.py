"""veilmark: find, redact and measure personal data in text tables with PySpark.

Documents stay rows; the spans found in a document travel with it as one array
column, so detection, span algebra and redaction are narrow (no shuffle), and
only corpus-level questions (profiles, metrics, curves) exchange data.
"""
