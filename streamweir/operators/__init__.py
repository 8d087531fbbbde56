"""DataFrame operators that work on batch and streaming input alike."""
