"""Text, rating, sales and detection-event analytics as Spark DataFrame jobs."""
