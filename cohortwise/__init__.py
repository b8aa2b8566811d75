"""Cohort preparation and evaluation for labelled collections, on Spark."""
