"""strandloom: genome-feature and corpus analytics as Spark DataFrame jobs."""
