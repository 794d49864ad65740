"""Compositions of operators: the pipeline, its command line and the registered queries."""
