"""Compositions of operators: the feature mart, the evaluation report, the query catalog."""
