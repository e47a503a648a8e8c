"""Streaming: the rolling visitor job as an availableNow / continuous file stream."""
