"""tidelake: hybrid batch + streaming transport analytics as plain Spark jobs.

``functions``  column builders (calendar, trip, event and report expressions)
``operators``  DataFrame -> DataFrame building blocks (rules, dimensions, ranks, checks)
``sources``    file scans, stream sources and the snapshot-versioned table
``plans``      batch dataflows: bronze, silver, gold, serving, integration
``streaming``  event-time jobs, keyed sinks and stateful alerts
"""
