"""Training-data operators over text and embeddings."""
