"""Incremental labelling of device location pings on Spark."""
