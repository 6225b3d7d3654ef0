"""Training-data operators over documents, embeddings and conversations."""
