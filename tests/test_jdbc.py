"""Statements and options for a database. No database is started: only texts are checked."""

from __future__ import annotations

import re

import pytest

from orderloom import schemas as S
from orderloom.config import JdbcConfig, JobConfig
from orderloom.sources import jdbc
from orderloom.sources.streams import kafka_options

CFG = JdbcConfig(url="jdbc:mysql://db/shop", table="order_lines", username="u", password="secret")


def test_options():
    assert jdbc.connection_options(CFG) == {
        "url": "jdbc:mysql://db/shop", "driver": "com.mysql.cj.jdbc.Driver", "user": "u", "password": "secret",
    }
    staged = jdbc.staging_options(CFG, "order_lines_staging")
    assert staged["dbtable"] == "order_lines_staging" and staged["batchsize"] == "100"


def test_password_is_not_shown():
    assert "secret" not in repr(CFG)


@pytest.mark.parametrize("change", [{"url": ""}, {"table": ""}, {"batch_size": 0}, {"connections": 0}])
def test_settings_are_required(change):
    with pytest.raises(ValueError):
        JdbcConfig(**({"url": "x", "table": "t", "username": "u", "password": "p"} | change))


@pytest.mark.parametrize(
    "change", [{"on_error": "ignore"}, {"line_number": "row"}, {"refresh": "daily"}, {"key_cols": ()}, {"lookup_shares": 0}]
)
def test_job_settings_are_checked(change):
    with pytest.raises(ValueError):
        JobConfig(**change)


def test_upsert_statement():
    sql = jdbc.upsert_statement(CFG, ["id", "remote_order_item_id"], "order_lines_staging")
    inserted, renewed = sql.split(" ON DUPLICATE KEY UPDATE ")
    assert inserted.startswith(f"INSERT INTO order_lines ({', '.join(S.SINK_COLUMNS)}) SELECT DISTINCT ")
    assert re.findall(r"(\w+) = VALUES\(\1\)", renewed) == S.LAST_WINS


def test_merge_statement():
    cfg = JdbcConfig(url="x", table="t", username="u", password="p", dialect="ansi")
    sql = jdbc.upsert_statement(cfg, ["id", "brand_id"], "s1")
    assert "ON t.id = s.id AND t.brand_id = s.brand_id" in sql and "FROM s1" in sql
    updated = re.findall(r"(\w+) = s\.\1", sql.split("UPDATE SET ")[1].split(" WHEN NOT")[0])
    assert updated == [c for c in S.LAST_WINS if c != "brand_id"]


def test_unknown_dialect():
    with pytest.raises(ValueError, match="dialect"):
        jdbc.upsert_statement(JdbcConfig(url="x", table="t", username="u", password="p", dialect="other"), ["id"], "s")


def test_kafka_options():
    options = kafka_options("host:9092", "orders", 1000)
    assert options["subscribe"] == "orders" and options["maxOffsetsPerTrigger"] == "1000"


class Reader:
    """Takes the place of `spark.read` and notes what it is asked for."""

    def __init__(self):
        self.asked = {}

    @property
    def read(self):
        return self

    def format(self, name):
        self.asked["format"] = name
        return self

    def options(self, **options):
        self.asked |= options
        return self

    def option(self, name, value):
        self.asked[name] = value
        return self

    def load(self):
        return self

    def jdbc(self, url, table, predicates, properties):
        self.asked |= {"url": url, "dbtable": table, "predicates": predicates, **properties}
        return self

    def select(self, *columns):
        self.asked["columns"] = columns
        return self


def test_query_text_is_run_by_the_database():
    reader = Reader()
    jdbc.read_query(reader, CFG, "select 1 as k;\n")
    assert reader.asked["format"] == "jdbc" and reader.asked["query"] == "select 1 as k"


def test_channels_are_read_whole_or_in_parts():
    whole, parts = Reader(), Reader()
    jdbc.read_channels(whole, CFG)
    jdbc.read_channels(parts, CFG, predicates=["channel_code < 'M'", "channel_code >= 'M'"])
    assert whole.asked["dbtable"] == parts.asked["dbtable"] == "oms_channel"
    assert len(parts.asked["predicates"]) == 2 and parts.asked["user"] == "u"
    assert whole.asked["columns"] == parts.asked["columns"] == ("channel_code", "channel_name")


def test_upsert_stages_one_row_per_key_before_it_merges(spark, monkeypatch):
    from orderloom import fixtures as fx
    from conftest import SMALL
    from pyspark.sql import DataFrameWriter

    steps = []
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: steps.append(("staged", self._df)))
    monkeypatch.setattr(jdbc, "_execute", lambda session, cfg, statements: steps.append(("merged", statements)))
    rows = fx.line_batches(spark, SMALL)
    jdbc.upsert(rows, CFG, ["id"], ["batch_id", "seq"])
    (first, staged), (second, (sql, cleared)) = steps
    assert (first, second) == ("staged", "merged") and sql.startswith("INSERT INTO order_lines")
    own = re.search(r"FROM (order_lines_staging_\w+) ", sql)[1]
    assert cleared == f"DROP TABLE {own}"
    # The connections' few partitions come after a shuffle of their own, not on top of the aggregate.
    text = staged._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in text and text.index("RoundRobinPartitioning(8)") < text.index("SortAggregate")
    assert staged.count() == rows.select("id").distinct().count()
    assert staged.rdd.getNumPartitions() <= CFG.connections and staged.columns == S.SINK_COLUMNS


def test_each_upsert_has_a_staging_table_of_its_own(spark, monkeypatch):
    from conftest import SMALL
    from orderloom import fixtures as fx
    from pyspark.sql import DataFrameWriter

    merged = []
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: None)
    monkeypatch.setattr(jdbc, "_execute", lambda session, cfg, statements: merged.append(statements[1]))
    for _ in range(2):
        jdbc.upsert(fx.line_batches(spark, SMALL), CFG, ["id"], ["batch_id", "seq"])
    assert len(set(merged)) == 2


@pytest.mark.parametrize("lost", ["staging", "merge"])
def test_a_failed_upsert_leaves_no_staging_table(spark, monkeypatch, lost):
    from conftest import SMALL
    from orderloom import fixtures as fx
    from pyspark.sql import DataFrameWriter

    asked = []

    def save(self):
        if lost == "staging":
            raise RuntimeError("lost")

    def execute(session, cfg, statements):
        asked.append(statements)
        if lost == "staging" or len(asked) == 1:
            raise RuntimeError("lost" if lost == "merge" else "no such table")

    monkeypatch.setattr(DataFrameWriter, "save", save)
    monkeypatch.setattr(jdbc, "_execute", execute)
    with pytest.raises(RuntimeError, match="^lost$"):
        jdbc.upsert(fx.line_batches(spark, SMALL), CFG, ["id"], ["batch_id", "seq"])
    assert len(asked[-1]) == 1 and re.fullmatch(r"DROP TABLE order_lines_staging_\w+", asked[-1][0])


def test_rows_without_a_key_are_refused(spark, monkeypatch):
    from conftest import SMALL
    from orderloom import fixtures as fx
    from pyspark.sql import functions as F

    monkeypatch.setattr(jdbc, "_execute", lambda *a: pytest.fail("must not get here"))
    rows = fx.line_batches(spark, SMALL).withColumn("id", F.expr("if(id = '1', null, id)"))
    with pytest.raises(ValueError, match="NULL in the key"):
        jdbc.upsert(rows, CFG, ["id"], ["batch_id", "seq"])


def test_a_dimension_query_is_checked(monkeypatch, spark):
    pairs = {"good": [("a", "1"), ("b", "2")], "twice": [("a", "1"), ("a", "2")], "null": [("a", None)]}
    monkeypatch.setattr(
        jdbc, "read_query", lambda session, cfg, query: spark.createDataFrame(pairs[query], "k string, v string")
    )
    assert jdbc.read_dimension(spark, CFG, "good", "k", "v").count() == 2
    for query, said in (("twice", "repeats"), ("null", "NULL")):
        with pytest.raises(ValueError, match=said):
            jdbc.read_dimension(spark, CFG, query, "k", "v")


def test_plain_inserts(spark, monkeypatch):
    from conftest import SMALL
    from orderloom import fixtures as fx
    from pyspark.sql import DataFrameWriter

    asked = {}

    def options(self, **given):
        asked.update(given)
        return self

    monkeypatch.setattr(DataFrameWriter, "options", options)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: asked.update(columns=self._df.columns))
    jdbc.append(fx.line_batches(spark, SMALL), CFG)
    assert asked["dbtable"] == "order_lines" and asked["batchsize"] == "100"
    assert asked["columns"] == S.APPEND_COLUMNS
