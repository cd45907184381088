"""Tierline: lake-pipeline operators as plain Spark DataFrame functions."""
