"""Point-in-time contract analytics as Spark jobs.

Layers, lowest first:

``functions``  column expressions (text, dates, money)
``sources``    landed JSON, raw table schemas, the day-partitioned raw store
``operators``  reusable DataFrame operators (latest snapshot, rule labels, rank, checks, changes)
``plans``      the models, views, reports, gates, history and the publish step
"""
