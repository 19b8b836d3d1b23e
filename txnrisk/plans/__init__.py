"""One module per layer or job, composed from operators and functions."""
