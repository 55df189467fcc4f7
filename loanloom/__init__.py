"""Credit-risk data mart, scoring and model monitoring, written for Spark."""
