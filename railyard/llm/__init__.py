"""Operators for training data: leaks, sampling, mixing, split overlap, runs, encoding, packing, repair."""
