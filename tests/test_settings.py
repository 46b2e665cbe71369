import pytest
from pyspark.sql import functions as F

from millrace.operators import settings as s
from millrace.sources.tables import read_config_tables


@pytest.mark.parametrize(
    "data, parent, want",
    [
        ([("abc.id", "1"), ("abc.f", "9"), ("other", "0"), ("abcd.x", "2")], "abc", {"id": "1", "f": "9"}),
        ([("kafka.abc", "1"), ("kafka.hi", "2")], "kafka", {"abc": "1", "hi": "2"}),
    ],
)
def test_sub_settings(rows, data, parent, want):
    got = s.sub_settings(rows(data, "key string, value string"), parent).collect()
    assert {r["key"]: r["value"] for r in got} == want


@pytest.fixture
def tables(rows):
    return {
        "kafka_logs": rows([("web", "hdfs", "h1", 1), ("app", "hdfs", "h2", 1), ("off", "hdfs", "h1", 0), ("ftp", "ftp", "h1", 1)], "log string, type string, host string, enabled int"),
        "kafka_log_encoders": rows([("web", "json-csv", None), ("app", "json-tsv", '[["a//b", 1]]'), ("odd", "avro", "")], "log string, type string, data string"),
        "source_log_fields": rows([(1, 2, "y/z", "boolean"), (1, 1, "x", "string"), (1, 10, "n", "int"), (2, 1, "q", "int")], "log_id bigint, field_id bigint, field_name string, data_type string"),
        "source_logs": rows([(1, "web"), (2, "app")], "log_id bigint, log_name string"),
    }


def test_enabled_topics_and_changes(rows, tables):
    wanted = s.enabled_topics(tables["kafka_logs"], "h1")
    assert [r["log"] for r in wanted.collect()] == ["web"]
    active = rows([("old",)], "log string")
    assert [r["log"] for r in s.topics_to_add(wanted, active).collect()] == ["web"]
    assert [r["log"] for r in s.topics_to_remove(wanted, active).collect()] == ["old"]


def definitions(tables):
    return s.encoder_definitions(tables["kafka_log_encoders"], tables["source_logs"], tables["source_log_fields"])


def test_columns_only_where_no_definition_is_given(tables):
    got = s.log_columns(tables["kafka_log_encoders"], tables["source_logs"], tables["source_log_fields"])
    assert sorted((r["log"], r["field_id"], r["path"], r["default"]) for r in got.collect()) == [
        ("web", 1, "x", ""), ("web", 2, "y/z", "false"), ("web", 10, "n", "-1"),
    ]
    by_log = {r["topic"]: [(d["path"], d["default"]) for d in r["definitions"]] for r in definitions(tables).collect()}
    assert by_log == {"web": [(["x"], ""), (["y", "z"], "false"), (["n"], "-1")], "app": [(["a", "b"], "1")], "odd": []}


def test_table_wins_over_property_over_default(rows, tables):
    topics = rows([("web",), ("odd",), ("new",), ("bare",)], "topic string")
    properties = rows(
        [("web", "encoder", "json"), ("new", "encoder", "json"), ("new", "decoder", "json"), ("web", "time_parser", "obj"), ("odd", "decoder", "nope")],
        "topic string, name string, value string",
    )
    got = s.resolve_settings(topics, definitions(tables), properties, {"encoder": "json-tsv"}).collect()
    assert {r["topic"]: (r["encoder"], r["decoder"], r["time_parser"]) for r in got} == {
        "web": ("json-csv", "default", "obj"),
        "odd": ("default", "default", "now"),
        "new": ("json", "json", "now"),
        "bare": ("json-tsv", "default", "now"),
    }


def test_tables_from_folder_and_catalog(spark, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/{name}")
        df.createOrReplaceTempView(f"view_{name}")
    from_folder = read_config_tables(spark, str(tmp_path))
    from_catalog = read_config_tables(spark, names={n: f"view_{n}" for n in tables})
    for name, df in tables.items():
        assert sorted(map(str, from_folder[name].collect())) == sorted(map(str, from_catalog[name].collect())) == sorted(map(str, df.collect()))


def test_custom_names_are_known(rows):
    none = rows([], "topic string, encoder string, definitions array<struct<path:array<string>,default:string>>")
    properties = rows([("t", "encoder", "pipe"), ("t", "decoder", "pairs")], "topic string, name string, value string")
    topics = rows([("t",)], "topic string")
    got = s.resolve_settings(topics, none, properties, decoders=["pairs"], custom_encoders=["pipe"]).first()
    assert (got["encoder"], got["decoder"]) == ("pipe", "pairs")
    assert s.resolve_settings(topics, none, properties).select(F.col("encoder")).first()[0] == "default"
