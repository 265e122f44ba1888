"""A PySpark-native engine for corpora of language-model completions."""
