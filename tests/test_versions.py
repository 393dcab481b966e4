"""Tables that are replaced as a whole or not at all."""

import os

import pytest
from conftest import listed
from pyspark.sql import functions as F

from dugout.sources.envelopes import FEEDS
from dugout.sources.tables import append_table, open_table, read_raw, read_table, replace_table
from dugout.sources.versions import versions
from dugout.streaming.land import land_batch, land_rows

SENT = "topic string, key string, value string, ts timestamp, run_id string"


def test_failed_write_leaves_the_old_rows(spark, values, tmp_path):
    root = str(tmp_path)
    replace_table(values("id int", 1, 2), root, "t")
    before = versions(spark, root, "t")
    broken = values("id int", 3).select(F.raise_error(F.lit("broken")).cast("int").alias("id"))
    with pytest.raises(Exception, match="broken"):
        replace_table(broken, root, "t")
    assert versions(spark, root, "t") == before
    assert listed(read_table(spark, root, "t")) == [(1,), (2,)]


def test_readers_keep_the_version_they_opened(spark, values, tmp_path):
    root = str(tmp_path)
    replace_table(values("id int", 1), root, "t")
    opened = read_table(spark, root, "t")
    replace_table(values("id int", 2), root, "t")
    assert listed(opened) == [(1,)] and listed(read_table(spark, root, "t")) == [(2,)]
    # A table may be replaced from itself.
    replace_table(read_table(spark, root, "t").selectExpr("id + 1 AS id"), root, "t")
    assert listed(read_table(spark, root, "t")) == [(3,)]
    assert len(versions(spark, root, "t")) == 2 == sum(e.is_dir() for e in os.scandir(tmp_path / "_versions/t"))


def test_plain_tables_are_replaced_and_appended_to(spark, values, tmp_path):
    root, schema = str(tmp_path), values("id int, part int").schema
    assert listed(open_table(spark, root, "t", schema, ["part"])) == []
    append_table(values("id int, part int", (1, 1)), root, "t", "part")
    assert listed(read_table(spark, root, "t", schema)) == [(1, 1)] and versions(spark, root, "t") == []
    replace_table(values("id int, part int", (2, 2)), root, "t", ["part"])
    append_table(values("id int, part int", (3, 3)), root, "t", "part")
    assert listed(open_table(spark, root, "t", schema, ["part"])) == [(2, 2), (3, 3)]


@pytest.mark.parametrize("sent, direct", [("r2", "d1"), ("a1", "b2")])
def test_direct_rows_replace_messages_whatever_their_run_is_called(spark, tmp_path, sent, direct):
    root = str(tmp_path)
    message = lambda run, key: spark.createDataFrame([("teams", str(key), f'{{"team_id": {key}}}', None, run)], SENT)
    land_batch(message(sent, 1), root, "feed", "000000000001")
    assert listed(read_raw(spark, root, "teams"), "team_id", "run_id") == [(1.0, sent)]
    rows = spark.createDataFrame([], FEEDS["teams"].schema)
    whole = spark.range(2).select(*[(F.col("id") if f.name == "team_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields])
    land_rows(whole, root, FEEDS["teams"], direct)
    assert listed(read_raw(spark, root, "teams"), "team_id", "run_id") == [(0.0, direct), (1.0, direct)]
    assert read_raw(spark, root, "teams", history=True).count() == 2
    land_batch(message(direct + "x", 7), root, "feed", "000000000002")
    assert listed(read_raw(spark, root, "teams"), "team_id", "run_id") == [(7.0, direct + "x")]
    broken = whole.withColumn("team_name", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        land_rows(broken, root, FEEDS["teams"], "z9")
    assert listed(read_raw(spark, root, "teams"), "team_id", "run_id") == [(7.0, direct + "x")]
