"""Seller-report normalisation and job-health analytics as lazy Spark plans.

Layout:
  functions/  Column -> Column expressions (text, money, ids, dates, zones)
  sources/    readers: delimited text, lines of files, binary files, JSON
  sinks/      writers: CSV, partitioned tables, publication markers
  operators/  frame-level operators (conform, dedup, merge, fill, format pick,
              hysteresis, job-health joins)
  plans/      jobs composed from operators, and the registered queries that
              run them over the driver's tables
  streaming/  Structured Streaming variants (arrival trigger, stateful alert)
"""

__version__ = "0.1.0"
