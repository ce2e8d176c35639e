"""Readers of VCF-family text and of the tables around it."""
