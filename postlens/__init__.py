"""Labelled-text analytics as composable Spark DataFrame operators.

The package never creates a session and never prints.  Operators take and
return lazy DataFrames; only ``plans`` and ``sources.views`` run jobs.
"""
