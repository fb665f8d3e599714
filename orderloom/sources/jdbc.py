"""Reading lookups from, and upserting lines into, a database."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.config import JdbcConfig
from orderloom.operators.dimensions import dimension
from orderloom.operators.upsert import latest_state


def connection_options(cfg: JdbcConfig) -> dict[str, str]:
    return {
        "url": cfg.url,
        "driver": cfg.driver,
        "user": cfg.username,
        "password": cfg.password,
    }


def read_query(spark: SparkSession, cfg: JdbcConfig, query: str) -> DataFrame:
    """The result of a SQL text run by the database."""
    text = query.strip().rstrip(";")
    return spark.read.format("jdbc").options(**connection_options(cfg)).option("query", text).load()


def read_dimension(spark: SparkSession, cfg: JdbcConfig, query: str, key: str, value: str) -> DataFrame:
    """A checked key-to-value table from a SQL text."""
    return dimension(read_query(spark, cfg, query), key, value)


def read_channels(
    spark: SparkSession, cfg: JdbcConfig, table: str = "oms_channel", predicates: Sequence[str] | None = None
) -> DataFrame:
    """The channel table; `predicates` (disjoint, covering) read it in that many parallel parts."""
    options = connection_options(cfg)
    if predicates:
        rows = spark.read.jdbc(options.pop("url"), table, predicates=list(predicates), properties=options)
    else:
        rows = spark.read.format("jdbc").options(**options).option("dbtable", table).load()
    return rows.select("channel_code", "channel_name")


def staging_options(cfg: JdbcConfig, staging: str) -> dict[str, str]:
    return connection_options(cfg) | {
        "dbtable": staging,
        "batchsize": str(cfg.batch_size),
        "truncate": "true",
    }


def upsert_statement(cfg: JdbcConfig, keys: Sequence[str], staging: str) -> str:
    """One statement that upserts a staging table into the target.

    DISTINCT takes out rows that a task attempt lost after its commit has written twice.
    """
    columns = ", ".join(S.SINK_COLUMNS)
    renewed = [c for c in S.LAST_WINS if c not in keys]
    if cfg.dialect == "mysql":
        updates = ", ".join(f"{c} = VALUES({c})" for c in renewed)
        return (
            f"INSERT INTO {cfg.table} ({columns}) SELECT DISTINCT {columns} FROM {staging} "
            f"ON DUPLICATE KEY UPDATE {updates}"
        )
    if cfg.dialect == "ansi":
        match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
        updates = ", ".join(f"{c} = s.{c}" for c in renewed)
        values = ", ".join(f"s.{c}" for c in S.SINK_COLUMNS)
        return (
            f"MERGE INTO {cfg.table} t USING (SELECT DISTINCT {columns} FROM {staging}) s ON {match} "
            f"WHEN MATCHED THEN UPDATE SET {updates} "
            f"WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({values})"
        )
    raise ValueError(f"unknown dialect {cfg.dialect!r}")


def _execute(spark: SparkSession, cfg: JdbcConfig, statements: Sequence[str]) -> None:
    """Run statements over one connection. The driver is asked by instance: the list of known drivers leaves out those
    that came with the application's packages."""
    jvm = spark.sparkContext._jvm
    loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
    login = jvm.java.util.Properties()
    login.setProperty("user", cfg.username)
    login.setProperty("password", cfg.password)
    connection = jvm.java.lang.Class.forName(cfg.driver, True, loader).newInstance().connect(cfg.url, login)
    try:
        call = connection.createStatement()
        try:
            for statement in statements:
                call.executeUpdate(statement)
        finally:
            call.close()
    finally:
        connection.close()


def upsert(rows: DataFrame, cfg: JdbcConfig, keys: Sequence[str], order: Sequence[str]) -> None:
    """Upsert lines: reduce to one row per key, stage them from the executors in a table of this run's own, merge in
    one statement. Running it again with the same rows changes nothing.

    A unique index takes any number of rows with a NULL in the key, so upserting them again would add them
    again; such rows are refused. The reduce runs at full width; only its result moves to the few partitions that
    write over a connection each.
    """
    if not rows.where(reduce(or_, [F.col(k).isNull() for k in keys])).isEmpty():
        raise ValueError(f"rows with NULL in the key {tuple(keys)} cannot be upserted")
    staging = f"{cfg.staging}_{uuid.uuid4().hex[:12]}"
    reduced = latest_state(rows, keys, order).repartition(cfg.connections)
    drop = f"DROP TABLE {staging}"
    try:
        reduced.write.format("jdbc").options(**staging_options(cfg, staging)).mode("overwrite").save()
        _execute(rows.sparkSession, cfg, [upsert_statement(cfg, keys, staging), drop])
    except Exception:
        with contextlib.suppress(Exception):  # it may not be there, or the database not answer; the first error counts
            _execute(rows.sparkSession, cfg, [drop])
        raise


def append(lines: DataFrame, cfg: JdbcConfig) -> None:
    """Plain inserts into the append-only table."""
    options = connection_options(cfg) | {"dbtable": cfg.table, "batchsize": str(cfg.batch_size)}
    lines.select(*S.APPEND_COLUMNS).write.format("jdbc").options(**options).mode("append").save()
