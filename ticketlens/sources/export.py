"""Files for other systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.semantics import ROWS_PER_FILE


def export_csv_chunks(
    df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, sep: str = ",", header: bool = True
) -> None:
    """CSV files of at most ``rows_per_file`` rows, each with its own header."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).csv(path, sep=sep, header=header)


def write_payloads(df: DataFrame, path: str, partition: str | None = "venue_id") -> None:
    """One JSON payload per line, in a folder per venue."""
    columns = ["payload"] if partition is None else [partition, "payload"]
    writer = df.select(*columns).write.mode("overwrite")
    (writer if partition is None else writer.partitionBy(partition)).text(path)


def split_csv_exact(
    df: DataFrame,
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    template: str = "split_%s.csv",
    sep: str = ";",
    header: bool = True,
) -> int:
    """CSV files of exactly ``rows_per_file`` rows (the last holds the rest), numbered from 1 in row order.

    Rows keep the order the DataFrame reads them in (partition, then position). Each row's global
    position is its partition's offset (from one count per partition: as many numbers as
    partitions reach the driver) plus its place in the partition; its file is position //
    ``rows_per_file`` + 1. Each file is written by one task and renamed to ``template % number``
    below ``path``. Fields are quoted only where they hold the separator, a quote or a line end,
    quotes are doubled, NULL and empty are both empty, white space is kept. An empty DataFrame
    gives one file with the header only. Returns the number of files.
    """
    if rows_per_file < 1:
        raise ValueError("at least one row per file")
    spark = df.sparkSession
    order, piece = "_position", "_piece"
    tagged = df.withColumn(order, F.monotonically_increasing_id())
    part = F.shiftright(F.col(order), 33)
    counts = sorted(tagged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    offsets = spark.createDataFrame(starts or [(0, 0)], "p long, start long")
    place = F.col("start") + F.col(order) - F.shiftleft(part, 33)  # offset of the partition + place in it
    numbered = tagged.join(F.broadcast(offsets), part == F.col("p")).withColumn(piece, (place / rows_per_file).cast("long") + 1)
    staged = f"{path}/_staged"
    options = {"sep": sep, "header": header, "escape": '"', "emptyValue": "", "nullValue": "",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n",
               "maxRecordsPerFile": 0}
    (
        numbered.repartition(piece)
        .sortWithinPartitions(piece, "start", order)
        .drop("p", "start", order)
        .write.partitionBy(piece)
        .options(**options)
        .csv(staged)
    )
    jvm = spark._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    pieces = -(-total // rows_per_file)
    for k in range(1, pieces + 1):
        found = [s.getPath() for s in fs.listStatus(jvm.org.apache.hadoop.fs.Path(f"{staged}/{piece}={k}")) if s.getPath().getName().startswith("part-")]
        fs.rename(found[0], jvm.org.apache.hadoop.fs.Path(f"{path}/{template % k}"))
    if pieces == 0:
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{path}/{template % 1}"))
        out.write(bytearray((sep.join(df.columns) + "\n").encode() if header else b""))
        out.close()
    fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)
    return max(pieces, 1)
