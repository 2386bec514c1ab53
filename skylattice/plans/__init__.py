"""Silver table, marts and the batch jobs that write them."""
