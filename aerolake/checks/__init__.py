"""Every operator as a query over the driver's tables, and the SQL twin of each."""
