"""Document indexing and retrieval as Spark jobs."""
