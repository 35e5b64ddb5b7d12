"""Reports, KPIs and the table build, put together from operators."""
