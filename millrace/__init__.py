"""Landing, conforming and publishing of raw tables as Spark jobs."""
