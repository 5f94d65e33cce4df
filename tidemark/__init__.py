"""Product analytics on Spark: activity cubes, audience reports, interval
anomaly bands and A/B-test statistics as lazy DataFrame transformations."""
