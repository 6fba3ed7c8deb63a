"""Usage, cost and quality analytics for LLM API calls, as Spark jobs."""
