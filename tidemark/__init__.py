"""Monthly extracts to cleaned tables, version histories, a star schema and marts on Spark."""
