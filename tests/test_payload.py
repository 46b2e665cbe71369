import pytest
from pyspark.sql import functions as F

from millrace.functions import payload as p

DEFS = [["a/b", 1], ["c/d", 2], ["e/f/g", 3]]
DATA = '[["a/b",1],["c/d",2],["e/f/g",3]]'


def values(rows, record_json, definitions):
    df = rows([(record_json, DATA)], "j string, data string")
    if definitions == "layout":
        definitions = p.definition_layout(p.parse_definitions(F.col("data")))
    return df.select(p.json_to_array(p.parse_record(F.col("j")), definitions).alias("v")).first()["v"]


@pytest.mark.parametrize("path", ["/a/b/c", "////a/b/c"])
def test_definition_paths(rows, path):
    assert p.definition_list([[path, 1]]) == [(["a", "b", "c"], "1")]
    got = rows([(f'[["{path}", 1]]',)], "d string").select(p.parse_definitions(F.col("d")).alias("d")).first()["d"]
    assert [(d["path"], d["default"]) for d in got] == [(["a", "b", "c"], "1")]


def test_definitions_in_order(rows):
    got = rows([(DATA,)], "d string").select(p.parse_definitions(F.col("d")).alias("d")).first()["d"]
    want = [(["a", "b"], "1"), (["c", "d"], "2"), (["e", "f", "g"], "3")]
    assert [(d["path"], d["default"]) for d in got] == want == p.definition_list(DATA)


@pytest.mark.parametrize("definitions", [p.definition_list(DATA), "layout"], ids=["fixed", "layout"])
@pytest.mark.parametrize(
    "record, want",
    [
        ("{}", ["1", "2", "3"]),
        ('{"a":{"b":"p"},"c":{"d":"q"},"e":{"f":{"g":"r"}}}', ["p", "q", "r"]),
        ('{"a":{"b":null},"c":5,"e":{"f":{}}}', [None, "2", "3"]),
        ('{"a":{"b":1.0},"c":{"d":[1,2]},"e":{"f":{"g":true}}}', ["1.0", "[1,2]", "true"]),
    ],
)
def test_json_to_array(rows, definitions, record, want):
    assert values(rows, record, definitions) == want


def test_json_to_csv_and_tsv(rows):
    df = rows([("{}",), ('{"a":{"b":null}}',)], "j string")
    record = p.parse_record(F.col("j"))
    got = df.select(
        p.json_to_csv(record, p.definition_list(DATA)).alias("c"), p.json_to_tsv(record, p.definition_list(DATA)).alias("t")
    ).collect()
    assert [tuple(r) for r in got] == [("1,2,3", "1\t2\t3"), (",2,3", "\t2\t3")]


def test_empty_path_gives_the_default(rows):
    df = rows([('{"a":1}',)], "j string")
    record = p.parse_record(F.col("j"))
    data = F.lit('[["", "x"], ["/", "y"], ["a", 0]]')
    laid = p.definition_layout(p.parse_definitions(data))
    fixed = p.definition_list('[["", "x"], ["/", "y"], ["a", 0]]')
    assert df.select(p.json_to_csv(record, fixed), p.json_to_csv(record, laid)).first()[:] == ("x,y,1", "x,y,1")


def test_quoting_is_an_option(rows):
    df = rows([('{"a":"x,y","b":"say \\"hi\\"","c":null,"d":"plain"}',)], "j string")
    record = p.parse_record(F.col("j"))
    defs = p.definition_list('[["a",0],["b",0],["c",0],["d",0]]')
    plain, quoted = df.select(p.json_to_csv(record, defs), p.json_to_csv(record, defs, quote=True)).first()
    assert plain == 'x,y,say "hi",,plain'
    assert quoted == '"x,y","say ""hi""",,plain'


@pytest.mark.parametrize("text, good", [('{"a":1}', True), ('{"a":1', False), ("[1,2]", False), ("7", False), ("", False), ("x", False)])
def test_only_objects_are_records(rows, text, good):
    df = rows([(text,)], "v string")
    record = p.decode_payload(F.col("v"), F.lit("json"))
    failed = p.decode_failed(F.col("v"), record, F.lit("json"))
    assert df.select(record.isNotNull(), failed).first()[:] == (good, not good)


def test_default_decoder_never_fails(rows):
    df = rows([("not json",), (None,)], "v string")
    record = p.decode_payload(F.col("v"), F.lit("anything"))
    got = df.select(record.isNull(), p.decode_failed(F.col("v"), record, F.lit("anything"))).collect()
    assert [tuple(r) for r in got] == [(True, False), (True, False)]


def test_encoders(rows):
    df = rows([(n,) for n in ("default", "json", "json-csv", "json-tsv", "no such")], "e string")
    value = F.lit('{"b": 1.0, "a": {"x": null}}')
    line = p.encode_payload(value, p.parse_record(value), F.col("e"), p.definition_list('[["b",0],["a/y","-"]]'))
    got = {r[0]: r[1] for r in df.select("e", line).collect()}
    assert got == {
        "default": '{"b": 1.0, "a": {"x": null}}',
        "json": '{"b":1.0,"a":{"x":null}}',
        "json-csv": "1.0,-",
        "json-tsv": "1.0\t-",
        "no such": '{"b": 1.0, "a": {"x": null}}',
    }


def test_default_encoder_keeps_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"\xff\x00\xfe"),)], "v binary")
    line = p.encode_payload(F.col("v"), p.parse_record(F.col("v")), F.lit("default"), [])
    assert df.select(F.hex(line.cast("binary"))).first()[0] == "FF00FE"


def test_type_defaults(rows):
    df = rows([("string",), ("boolean",), ("int",)], "t string")
    assert [r[0] for r in df.select(p.type_default(F.col("t"))).collect()] == ["", "false", "-1"]
