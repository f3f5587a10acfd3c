"""Text retrieval and ranking as Spark jobs: index tables, batch scoring, fusion, evaluation."""
