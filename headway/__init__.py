"""headway: a Spark-native engine for measuring schedule punctuality.

Observed stop events (realtime polls) are matched to the versioned
schedule that was valid on their service date, turned into a stop-event
fact table with latest-attribute dimensions, and summarised by route,
hour and stop.  Every step is a DataFrame transformation; nothing is
collected to the driver except one-row status results.

Layout
------
sources/    landing-zone readers, archive unpacking, derived test inputs
functions/  column expressions (GTFS times, dates, buckets, time zones)
operators/  staging, version matching, dedup, marts, analytics, checks
plans/      end-to-end builds, sinks/publishing, oracle SQL
streaming/  Structured Streaming landing and incremental marts
"""

__version__ = "0.1.0"
