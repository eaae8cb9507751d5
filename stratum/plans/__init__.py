"""Compositions of operators: prepare fit/apply, model sweeps, ensembles, publishing,
and the query catalog used by ``__spark_entry__``."""
