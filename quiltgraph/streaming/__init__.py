"""Change data: decoders, pulling loops, and one changelog that batches and streams apply."""
