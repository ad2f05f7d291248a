"""Composed plans: the trusted feature table, the Spark ML training / scoring plan and
the metadata document."""
