"""Road-traffic probe analytics and corpus preparation as Spark jobs."""
