"""Spark operators for corpus counts, post statistics, tabular reports and imaging experiments."""
