"""DataFrame -> DataFrame operators (staging, windows, marts, metrics,
incremental loads, history, layout, data quality)."""
