"""Ticket booking and payment analytics on Spark.

The package turns two event feeds (bookings, payments) into one seat-level
fact table and reports on it.  Everything is a ``DataFrame -> DataFrame``
function, so the same code runs on stored tables and on streams:

``functions``  column expressions (rules, time, money text)
``operators``  validate, flatten, interval join, audits, lookups
``plans``      the fact table, KPIs, segments, trends, report payload
``sources``    event codecs, table lifecycle, replay of stored orders
``streaming``  continuous versions, windows and sinks
"""
