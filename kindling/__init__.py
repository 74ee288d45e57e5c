"""kindling: a Spark-native text triage engine.

Cleans raw short texts, resolves conflicting duplicate labels, derives text
features, makes exact stratified splits, builds TF-IDF / embedding
representations, fits and compares logistic-regression models behind a
promotion gate, scores batches and streams with one code path, and detects
distribution drift - every row-scale step is a Spark DataFrame, Spark ML or
Structured Streaming job.
"""

__version__ = "0.1.0"
