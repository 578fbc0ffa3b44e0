"""Readers of flat files, taxonomy dumps, ontologies and tab-separated tables; every schema is explicit."""
