"""Expert media monitoring as Spark jobs."""
