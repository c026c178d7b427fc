"""quarry: document analytics on Spark DataFrames.

Profiling, cleaning, exact dedup, TF-IDF features, classifier training and
scoring, and rule-based invoice field extraction, written as Spark jobs.
"""

__version__ = "0.1.0"
