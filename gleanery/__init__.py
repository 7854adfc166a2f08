"""gleanery: captured web pages and extracted JSON answers in, a curated table out.

Every stage is ``DataFrame -> DataFrame`` built from Spark's own expressions; only
``plans.build`` starts jobs.
"""
