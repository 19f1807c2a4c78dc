"""starmart: a transport-analytics warehouse expressed as Spark DataFrame jobs."""
