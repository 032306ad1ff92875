"""Published tables, reports, checks and the batch job that composes them."""
