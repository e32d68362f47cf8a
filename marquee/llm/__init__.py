"""Training-data operators: dedup, filters, classifiers and tokenizers on Spark."""
