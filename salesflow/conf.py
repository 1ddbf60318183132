"""Session settings: a table-format catalog on an S3-compatible object store, and cluster sizing.

The caller passes every value (endpoint, credentials, bucket); nothing is read from the
environment here. Apply with ``SparkSession.builder.config(map=lake_conf(...))``. The connector
jars themselves must be on the cluster's classpath.
"""

from __future__ import annotations


def lake_conf(catalog: str, warehouse: str, s3_endpoint: str | None = None,
              access_key: str | None = None, secret_key: str | None = None,
              path_style: bool = True) -> dict[str, str]:
    """Iceberg catalog (Hadoop catalog: metadata kept in the warehouse folder) + S3A access."""
    conf = {
        "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
        f"spark.sql.catalog.{catalog}": "org.apache.iceberg.spark.SparkCatalog",
        f"spark.sql.catalog.{catalog}.type": "hadoop",
        f"spark.sql.catalog.{catalog}.warehouse": warehouse,
    }
    if s3_endpoint:
        conf.update({
            "spark.hadoop.fs.s3a.endpoint": s3_endpoint,
            "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
            "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        })
    if access_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key is not None:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Shuffle and scan sizing for a large cluster, from the input volume and the core count.

    Scan splits and shuffle partitions aim at ``target_partition_bytes`` each, so a task's data
    fits in its share of executor memory. The initial shuffle partition count covers the input at
    that size (at least 3 waves of tasks); adaptive execution then coalesces small partitions and
    splits skewed ones at run time, so a hot key does not land whole on one task.
    """
    initial = max(3 * cores, -(-input_bytes // target_partition_bytes))
    size = f"{max(1, target_partition_bytes // 1024 ** 2)}m"
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.files.maxPartitionBytes": size,
    }
