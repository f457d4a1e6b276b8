"""Operators of a training-data pipeline.  Nothing outside this package imports it but
the driver's entry file, which leaves it out where it is missing."""
