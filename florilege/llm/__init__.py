"""Operators that prepare text for language-model training, each a Spark job over whole tables."""
