"""The job's queries over the driver's tables, with the SQL they are compared to."""
