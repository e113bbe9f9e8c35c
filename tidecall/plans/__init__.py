"""Ready-made plans: the contact table, end-to-end jobs and the query catalogue."""
