"""The publish and consume legs on Structured Streaming."""
