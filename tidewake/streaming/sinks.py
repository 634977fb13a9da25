"""Sinks of streams: ``foreachBatch`` functions that may be called again with a batch that they have written before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.sources import ais

Sink = Callable[[DataFrame, int], None]


def _renamed_over(spark: SparkSession, source: str, target: str) -> None:
    """One atomic step of the file system: whoever reads the target finds the old file or the new one."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(source)
    over = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    over[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration()).rename(path, hadoop.Path(target), over)


def _written(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def _pointed_at(spark: SparkSession, path: str) -> str | None:
    """The name in the pointer file; null before the first result."""
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/current")
    files = pointer.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_table(path: str, keep: int = 2) -> Sink:
    """Each result in place of the last: written beside it, then a pointer moves.  The ``keep`` newest stay for those who still read them."""

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"batch-{batch_id:012d}"
        batch.write.mode("overwrite").parquet(f"{path}/{name}")
        _written(spark, f"{path}/next", name)
        _renamed_over(spark, f"{path}/next", f"{path}/current")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        held = sorted(x.getPath().getName() for x in files.listStatus(folder) if x.getPath().getName().startswith("batch-"))
        for old in [x for x in held if x <= name][:-keep]:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{old}"), True)

    return put


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The last result that ``replace_table`` has put."""
    name = _pointed_at(spark, path)
    if name is None:
        raise FileNotFoundError(f"no result yet below {path}")
    return spark.read.parquet(f"{path}/{name}")


def by_day_and_kind(path: str, kind: str = "msg_type", time: str = "ts") -> Sink:
    """Rows into folders by kind and day; a batch that comes again takes the place of its own files and of no others."""

    def put(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumns({"day": F.to_date(time), "batch": F.lit(batch_id)})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(kind, "day", "batch").parquet(path)

    return put


def decoded_by_day(path: str) -> Sink:
    """Payloads with ``ts``, as ``assembled_stream`` gives them, decoded into folders by type of message and day."""
    into = by_day_and_kind(path)
    return lambda batch, batch_id: into(ais.decoded(batch, carried=["receiver", "ts"]), batch_id)


def replace_jdbc(url: str, name: str, properties: dict[str, str]) -> Sink:
    """Each result in place of the last in a database table: truncated and filled again."""
    return lambda batch, _: batch.write.option("truncate", "true").jdbc(url, name, mode="overwrite", properties=properties)


def upsert_jdbc(url: str, name: str, keys: list[str], order: str, properties: dict[str, str], stream: str = "stream") -> Sink:
    """Keyed inserts and updates of a database table, once for each batch of ``stream``.

    Tasks write the batch, the last row by ``order`` of each key, into a table of its own beside ``name``.  Then one transaction
    of the database merges it and notes the batch in the table ``<name>_batches``: either both happen or neither, and a batch that
    is noted is passed over.  ``name`` has the columns of the batch and exists, as does ``<name>_batches`` with ``stream varchar, batch
    bigint``.  The merge is the SQL standard's ``MERGE``.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        jvm, known = spark._jvm, f"{name}_batches"
        rest = [c for c in batch.columns if c not in keys]
        last = batch.groupBy(*keys).agg(F.max(F.struct(F.col(order).alias("_order"), *rest)).alias("last")).select(*keys, *[F.col(f"last.{c}").alias(c) for c in rest])
        jvm.java.lang.Class.forName(properties["driver"])
        login = jvm.java.util.Properties()
        for k, v in properties.items():
            login.setProperty(k, v)
        link = jvm.java.sql.DriverManager.getConnection(url, login)
        try:
            link.setAutoCommit(False)
            asked = link.prepareStatement(f"select count(*) from {known} where stream = ? and batch = ?")
            asked.setString(1, stream)
            asked.setLong(2, batch_id)
            found = asked.executeQuery()
            found.next()
            seen = found.getLong(1)
            link.commit()
            if seen:
                return
            beside = f"{name}_next"
            last.write.option("truncate", "true").jdbc(url, beside, mode="overwrite", properties=properties)
            quoted = {c: f'"{c}"' for c in batch.columns}
            on = " and ".join(f"t.{quoted[c]} = n.{quoted[c]}" for c in keys)
            change = ", ".join(f"{quoted[c]} = n.{quoted[c]}" for c in rest)
            columns, values = ", ".join(quoted.values()), ", ".join(f"n.{q}" for q in quoted.values())
            work = link.createStatement()
            work.executeUpdate(f"merge into {name} t using {beside} n on {on} when matched then update set {change} when not matched then insert ({columns}) values ({values})")
            noted = link.prepareStatement(f"insert into {known} values (?, ?)")
            noted.setString(1, stream)
            noted.setLong(2, batch_id)
            noted.executeUpdate()
            link.commit()
        except Exception:
            link.rollback()
            raise
        finally:
            link.close()

    return put
