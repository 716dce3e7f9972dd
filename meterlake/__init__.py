"""meterlake: smart-meter analytics on Spark.

Raw half-hourly readings are replayed as keyed JSON messages, parsed, cleaned
and enriched with household and hourly weather dimensions (silver), rolled up
into sliding-window load indicators (gold), scored per meter with a
weather-aware running z-score (alerts), and summarised into data-quality,
behaviour, grid-stress and alert reports. Every operator takes and returns
DataFrames; the streaming forms run the same logical plans under Structured
Streaming.
"""

__version__ = "0.1.0"
