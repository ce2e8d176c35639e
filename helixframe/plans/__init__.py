"""Composite analyses over genotype, site, annotation and span tables."""
