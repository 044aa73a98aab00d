import json

import pytest

from rowharbor.control import (
    NO_QUOTE,
    ControlError,
    check_action,
    check_encoding,
    check_formats,
    control_json,
    generate_control,
    parse_control,
    parse_port_control,
)
from rowharbor.functions.patterns import DEFAULT_TIME_FORMATS, UnsupportedPattern, translate


def control(block, **top):
    return parse_control(json.dumps({"action": "Upsert", "csv": block, **top}))


def test_generated_control_for_replace():
    got = control_json(generate_control("my.csv", "replace", ["id", "name"]))
    assert got == {
        "action": "Replace",
        "csv": {
            "columns": ["id", "name"],
            "columnStatistics": True,
            "emptyTextIsNull": True,
            "encoding": "utf-8",
            "fixedTimestampFormat": list(DEFAULT_TIME_FORMATS),
            "floatingTimestampFormat": list(DEFAULT_TIME_FORMATS),
            "ignoreColumns": [],
            "overrides": {},
            "quote": '"',
            "separator": ",",
            "setAsideErrors": False,
            "skip": 0,
            "timezone": "UTC",
            "trimServerWhitespace": False,
            "trimWhitespace": True,
            "useGeocoding": False,
        },
    }


def test_generated_tsv_has_no_quote():
    got = generate_control("x.TSV", "upsert")
    assert got.csv is None and got.file.quote == NO_QUOTE and got.file.separator == "\t"
    assert not got.file.column_statistics


def test_round_trip():
    made = generate_control("a.csv", "upsert", ["x"])
    assert control_json(parse_control(json.dumps(control_json(made)))) == control_json(made)


def test_unknown_keys():
    assert control({}, somethingNew=1).file.skip == 0
    with pytest.raises(ControlError):
        control({"somethingNew": 1})
    with pytest.raises(ControlError):
        control({"overrides": {"a": {"nope": 1}}})
    with pytest.raises(ControlError):
        parse_control('{"action": Upsert}')


def test_one_value_for_a_list_and_all_formats():
    got = control({
        "floatingTimestampFormat": "ISO8601",
        "fixedTimestampFormat": "MM/dd/yy",
        "overrides": {"a": {"timestampFormat": "MM/YYYY"}, "b": {"timestampFormat": ["ISO8601"]}},
    }).file
    assert got.all_formats() == ["ISO8601", "MM/dd/yy", "MM/YYYY"]
    assert got.for_column("a").floating_formats == ["MM/YYYY"]
    assert got.for_column("c").fixed_formats == ["MM/dd/yy"]


def test_provider_named_geocoding_switch():
    got = control({"useAnyGeocoding": True, "overrides": {"a": {"useAnyGeocoding": False}}}).file
    assert got.use_geocoding and got.overrides["a"].use_geocoding is False


def test_csv_wins():
    got = parse_control('{"csv": {"skip": 1}, "tsv": {"skip": 2}}')
    assert got.file.skip == 1 and got.tsv.separator == "\t"


def test_synthetic_columns():
    got = control({
        "syntheticLocations": {"loc": {"address": "street", "city": "", "zip": "plz"}},
        "syntheticPoints": {
            "p": {"type": "point", "latitude": "lat", "longitude": "lon"},
            "g": {"type": "geocoded", "city": "town", "country": "land"},
        },
    }).file
    assert got.synthetic_locations["loc"].parts == {"address": "street", "zip": "plz"}
    assert got.synthetic_points["p"].kind == "point"
    assert got.synthetic_points["g"].parts == {"city": "town", "country": "land"}
    with pytest.raises(ControlError):
        control({"syntheticPoints": {"p": {"type": "other"}}})


@pytest.mark.parametrize("pattern,spark", [
    ("ISO8601", None), ("MM/dd/yyyy", "M/d/yyyy"), ("MM/dd/yy", "M/d/yy"), ("MM/YYYY", "M/yyyy"),
    ("dd-MMM-yyyy", "d-MMM-yyyy"), ("yyyyMMdd", "yyyyMMdd"), ("MM/dd/yyyy hh:mm:ss a Z",
                                                              "M/d/yyyy h:m:s a [XXX][XX]"),
    ("yyyy'T'HH", "yyyy'T'H"),
])
def test_patterns(pattern, spark):
    assert translate(pattern).spark == spark


@pytest.mark.parametrize("pattern", ["", "MM/dd/jjjj", "nonsense", "yyyy'open"])
def test_bad_patterns(pattern):
    with pytest.raises(UnsupportedPattern):
        translate(pattern)


def test_checks_without_data():
    bad = control({"floatingTimestampFormat": ["iso8601", "bogus"], "encoding": "utf-99"}).file
    assert len(check_formats(bad)) == 1 and len(check_encoding(bad)) == 1
    assert check_encoding(control({"encoding": "ISO-8859-1"}).file) == []
    odd = control({"encoding": "windows-1252"}).file
    assert check_encoding(odd) and not check_encoding(odd, java_charsets=True)
    assert check_action("Upsert", None) == []
    assert check_action("Merge", None) and check_action(None, None)
    assert check_action("Delete", None) and not check_action("Delete", "id")
    assert check_action("Upsert", "id", requested="replace")
    assert check_action("Append", "id", job="port") and check_action("Upsert", "id", job="gis")


def test_port_control():
    text = '{"sourceDataset": "ab12-cd34", "copyType": {"type": "schema_and_data"}, "more": 1}'
    got = parse_port_control(text)
    assert (got.source_dataset, got.copy, got.publish) == ("ab12-cd34", "all", True)
    with pytest.raises(ControlError):
        parse_port_control('{"sourceDataset": "x", "copyType": {"type": "nothing"}}')
