"""Rule tables used by queries and tests."""

from __future__ import annotations

from ..operators.alerts import AlertRule

# Names, expressions, thresholds, holding times and severities of the service's alert rules.
SERVICE_RULES = [
    AlertRule("SpiceDBHighErrorRate", "rate", "spicedb_grpc_server_handled_total", None, "grpc_code", "!=", "OK", None, ">", 0.05, 300, "warning", "spicedb"),
    AlertRule("SpiceDBHighLatency", "quantile", "spicedb_grpc_server_handling_seconds_bucket", None, None, None, None, 0.99, ">", 1, 300, "warning", "spicedb"),
    AlertRule("SpiceDBDown", "gauge", "up", None, "job", "=", "spicedb", None, "==", 0, 60, "critical", "spicedb"),
    AlertRule("RedisLowHitRate", "rate_share", "redis_keyspace_hits_total", "redis_keyspace_misses_total", None, None, None, None, "<", 0.5, 600, "warning", "redis"),
    AlertRule("RedisHighMemory", "ratio", "redis_memory_used_bytes", "redis_memory_max_bytes", None, None, None, None, ">", 0.9, 300, "warning", "redis"),
    AlertRule("RedisHighEvictionRate", "rate", "redis_evicted_keys_total", None, None, None, None, None, ">", 10, 300, "warning", "redis"),
    AlertRule("RedisDown", "gauge", "up", None, "job", "=", "redis", None, "==", 0, 60, "critical", "redis"),
    AlertRule("PostgresTooManyConnections", "total_ratio", "pg_stat_activity_count", "pg_settings_max_connections", None, None, None, None, ">", 0.8, 300, "warning", "postgres"),
    AlertRule("PostgresReplicationLag", "gauge", "pg_replication_lag", None, None, None, None, None, ">", 30, 300, "warning", "postgres"),
    AlertRule("PostgresDown", "gauge", "up", None, "job", "=", "postgres", None, "==", 0, 60, "critical", "postgres"),
    AlertRule("KafkaHighConsumerLag", "gauge", "kafka_consumergroup_lag", None, None, None, None, None, ">", 1000, 300, "warning", "kafka"),
    AlertRule("KafkaUnderReplicatedPartitions", "gauge", "kafka_server_replicamanager_underreplicatedpartitions", None, None, None, None, None, ">", 0, 300, "warning", "kafka"),
    AlertRule("KafkaDown", "gauge", "up", None, "job", "=", "kafka", None, "==", 0, 60, "critical", "kafka"),
    AlertRule("HighCPUUsage", "busy_percent", "node_cpu_seconds_total", None, "mode", "=", "idle", None, ">", 80, 300, "warning", "system"),
    AlertRule("HighMemoryUsage", "percent_used", "node_memory_MemAvailable_bytes", "node_memory_MemTotal_bytes", None, None, None, None, ">", 90, 300, "warning", "system"),
    AlertRule("LowDiskSpace", "percent", "node_filesystem_avail_bytes", "node_filesystem_size_bytes", None, None, None, None, "<", 10, 300, "warning", "system"),
]

# Expressions and thresholds of the consumer's alert rules; they have no holding time.
CONSUMER_RULES = [
    AlertRule("High Error Rate", "rate", "rbac_kafka_consumer_validation_errors_total", None, None, None, None, None, ">", 0.1, 0, "warning", "consumer"),
    AlertRule("Message Processing Stalled", "rate", "rbac_kafka_consumer_messages_processed_total", None, None, None, None, None, "==", 0, 0, "warning", "consumer"),
    AlertRule("High Retry Rate", "rate", "rbac_kafka_consumer_retry_attempts_total", None, None, None, None, None, ">", 1, 0, "warning", "consumer"),
    AlertRule("Slow Processing", "quantile", "rbac_kafka_consumer_message_processing_duration_seconds_bucket", None, None, None, None, 0.99, ">", 10, 0, "warning", "consumer"),
]
