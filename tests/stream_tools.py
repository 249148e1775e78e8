"""Turn a small table into an ordered file stream, one file per batch."""

from pyspark.sql import functions as F


def write_batches(df, batch_col, folder):
    ids = [r[0] for r in df.select(batch_col).distinct().orderBy(batch_col).collect()]
    for i in ids:
        df.where(F.col(batch_col) == i).coalesce(1).write.mode("append").parquet(folder)
    return len(ids)
