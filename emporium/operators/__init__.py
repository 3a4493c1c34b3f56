"""DataFrame → DataFrame operators used by the reports and table jobs."""
