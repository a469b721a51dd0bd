"""DataFrame -> DataFrame transforms; nothing here runs a job or touches storage."""
