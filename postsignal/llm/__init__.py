"""Training-data operators: thirteen methods on documents, pages and embeddings, and their queries."""
