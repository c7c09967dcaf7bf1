"""Incremental (Structured Streaming) form of the bronze -> silver ingest."""

from tierline.streaming.incremental import read_stream_silver, start_weather_ingest, weather_silver_stream

__all__ = ["read_stream_silver", "start_weather_ingest", "weather_silver_stream"]
