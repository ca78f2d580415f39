"""Project cost and performance marts as plain DataFrame functions."""
