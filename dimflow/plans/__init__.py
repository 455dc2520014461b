"""Compositions of operators: layout advice, table definitions, the star build and the batch job."""
