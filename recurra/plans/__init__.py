"""Compositions of the operators: the daily rebuild, named queries, and the
SQL oracle used to check them."""
