"""Tessera: a Spark-first engine for evidence catalogues and corpus preparation."""
