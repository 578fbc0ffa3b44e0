"""Spark-native tables for metaproteomics: flat-file and taxonomy sources, lineages, peptides, common ancestors, annotations and indexes."""
