"""Tables in a remote database, read and written in parallel over JDBC."""


def jdbc_read_options(url, query, split_column=None, bounds=None, partitions=None):
    """Options for a query source; with a split column each task reads one range."""
    options = {"url": url, "dbtable": f"({query}) AS q", "fetchsize": "10000"}
    if split_column:
        low, high = bounds
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def read_remote(spark, **source):
    return spark.read.format("jdbc").options(**jdbc_read_options(**source)).load()


def append_remote(df, url, table, batch_size=10_000, partitions=16):
    """Append over a bounded number of connections, in batches of bound rows."""
    df.write.format("jdbc").mode("append").options(
        url=url, dbtable=table, batchsize=batch_size, numPartitions=partitions
    ).save()
