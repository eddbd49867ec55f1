"""Text-corpus preparation and token modelling as Spark jobs."""
