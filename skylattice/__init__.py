"""Aircraft position analytics on Spark: bronze, silver, marts and sessions."""
