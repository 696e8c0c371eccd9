"""Bank-transaction control engine on Spark: staging, rules, queue, marts, anomaly scores."""
