"""Decision analytics on Spark: features, point-in-time joins, rules, statistics, graphs and streams as DataFrame functions."""
