"""Layered refinement of raw delimited records into business metrics on Spark.

Raw text goes in, three tables come out: *bronze* (the text as received, plus
lineage), *silver* (typed, valid, derived, unique) and *gold* (grouped
metrics).  Every operator takes a DataFrame and returns a lazy DataFrame; only
the jobs in :mod:`siftlayer.plans.jobs` start Spark actions.
"""
