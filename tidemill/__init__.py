"""Link ranking, global ordering and data-parallel fitting as Spark jobs."""
