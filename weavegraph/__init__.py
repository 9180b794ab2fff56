"""Reference-graph and corpus-quality operators, written as PySpark DataFrame functions."""
