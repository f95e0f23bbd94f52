"""Structured Streaming operators (J1–J3): replays of the batch operators
over file streams, with watermarks and per-key state."""
