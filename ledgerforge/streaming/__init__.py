"""The live cycle as Structured Streaming."""
