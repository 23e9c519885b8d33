"""DataFrame-to-DataFrame steps shared by the batch and the streaming paths."""
