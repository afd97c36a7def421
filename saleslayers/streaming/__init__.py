"""The same loads driven by Structured Streaming: each file once, restartable."""
