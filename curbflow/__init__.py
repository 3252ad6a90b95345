"""Mobility analytics on Spark: ingest, profile and question operators over trip tables.

Every operator takes DataFrames and returns a DataFrame; nothing in ``operators``
or ``functions`` starts a job.  Jobs are started by the sinks in ``sources`` and by
``plans.report``.
"""
