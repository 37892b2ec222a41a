"""Streaming.

The reference reads whole files only: no stream source, watermark, event-time
window, state or late-data handling exists in it, so no streaming operator
is built here. The row-level feature functions (calendar, weather, physics,
clip rules) are plain projections and apply unchanged to a streaming
DataFrame from ``spark.readStream``; the per-group window stages need the
whole history of a group and are batch operators.
"""
