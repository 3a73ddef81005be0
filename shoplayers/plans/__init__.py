"""Jobs: the layered warehouse, its reports, the review pipeline and the query catalogue."""
