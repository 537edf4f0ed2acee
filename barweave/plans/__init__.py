"""The daily and intraday computations, built from operators."""
