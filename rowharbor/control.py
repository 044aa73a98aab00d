"""Control files: the JSON options that say how a delimited file is read and published."""

from __future__ import annotations

import codecs
import json
import re
from dataclasses import dataclass, field, fields, replace

from rowharbor.functions.patterns import (
    DEFAULT_TIME_FORMATS,
    UnsupportedPattern,
    translate_all,
)

ACTIONS = ("replace", "upsert", "append", "delete")
NO_QUOTE = "\u0000"

# The switch for geocoding carries its provider's name: use<Provider>Geocoding.
_GEOCODING_SWITCH = re.compile(r"^use[A-Za-z]*Geocoding$")

LOCATION_PARTS = ("address", "city", "state", "zip", "latitude", "longitude")
GEOCODED_PARTS = ("address", "city", "state", "zip", "country")
POINT_PARTS = ("latitude", "longitude")


class ControlError(ValueError):
    """A control file that cannot be understood."""


def _as_list(value):
    """One value is accepted where a list is expected."""
    if value is None or isinstance(value, list):
        return value
    return [value]


def _take(kind, raw: dict, names: dict[str, str]) -> dict:
    """Map JSON keys to attribute names; a key nobody knows is an error."""
    if not isinstance(raw, dict):
        raise ControlError(f"{kind}: expected an object")
    out = {}
    for key, value in raw.items():
        if _GEOCODING_SWITCH.match(key):
            key = "useGeocoding"
        if key not in names:
            raise ControlError(f"{kind}: unknown option '{key}'")
        out[names[key]] = value
    return out


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(p.capitalize() for p in rest)


def _names(cls) -> dict[str, str]:
    return {_camel(f.name): f.name for f in fields(cls) if not f.metadata.get("hidden")}


def _hidden(default):
    return field(default=default, metadata={"hidden": True})


@dataclass(frozen=True)
class ColumnOverride:
    """Options of one column; None means "as the file says"."""

    trim_whitespace: bool | None = None
    trim_server_whitespace: bool | None = None
    use_geocoding: bool | None = None
    empty_text_is_null: bool | None = None
    timestamp_format: list[str] | None = None
    timezone: str | None = None

    @classmethod
    def parse(cls, raw: dict) -> "ColumnOverride":
        got = _take("override", raw, _names(cls))
        got["timestamp_format"] = _as_list(got.get("timestamp_format"))
        return cls(**got)


@dataclass(frozen=True)
class Synthetic:
    """A composite column made of other columns: part name to column name."""

    kind: str  # location, point or geocoded
    parts: dict[str, str]

    @classmethod
    def parse_location(cls, raw: dict) -> "Synthetic":
        known = {p: p for p in LOCATION_PARTS} | {"type": "type"}
        got = _take("synthetic location", raw, known)
        return cls("location", {p: got[p] for p in LOCATION_PARTS if got.get(p)})

    @classmethod
    def parse_point(cls, raw: dict) -> "Synthetic":
        kind = raw.get("type") if isinstance(raw, dict) else None
        wanted = {"point": POINT_PARTS, "geocoded": GEOCODED_PARTS}.get(kind)
        if wanted is None:
            raise ControlError(f"synthetic point: unknown type '{kind}'")
        got = _take("synthetic point", raw, {p: p for p in wanted} | {"type": "type"})
        return cls(kind, {p: got[p] for p in wanted if got.get(p)})


@dataclass(frozen=True)
class FileControl:
    """Options of the ``csv`` or ``tsv`` block."""

    encoding: str | None = "utf-8"
    separator: str | None = None
    quote: str | None = '"'
    escape: str | None = None
    columns: list[str] | None = None
    ignore_columns: list[str] = field(default_factory=list)
    skip: int = 0
    trim_whitespace: bool = True
    trim_server_whitespace: bool = False
    empty_text_is_null: bool = True
    floating_timestamp_format: list[str] = field(default_factory=lambda: list(DEFAULT_TIME_FORMATS))
    fixed_timestamp_format: list[str] = field(default_factory=lambda: list(DEFAULT_TIME_FORMATS))
    timezone: str = "UTC"
    drop_uninterpretable_rows: str | None = None
    overrides: dict[str, ColumnOverride] = field(default_factory=dict)
    synthetic_locations: dict[str, Synthetic] = field(default_factory=dict)
    synthetic_points: dict[str, Synthetic] = field(default_factory=dict)
    analytic_locations: dict | None = None
    use_geocoding: bool = False
    action: str | None = None
    column_statistics: bool = False
    set_aside_errors: bool = False
    # not part of the JSON
    has_header_row: bool = _hidden(True)
    multi_line: bool = _hidden(True)

    @classmethod
    def parse(cls, raw: dict, kind: str) -> "FileControl":
        got = {k: v for k, v in _take(kind, raw, _names(cls)).items() if v is not None}
        for name in ("columns", "ignore_columns", "floating_timestamp_format",
                     "fixed_timestamp_format"):
            if name in got:
                got[name] = _as_list(got[name])
        got["overrides"] = {
            k: ColumnOverride.parse(v) for k, v in got.get("overrides", {}).items()
        }
        got["synthetic_locations"] = {
            k: Synthetic.parse_location(v) for k, v in got.get("synthetic_locations", {}).items()
        }
        got["synthetic_points"] = {
            k: Synthetic.parse_point(v) for k, v in got.get("synthetic_points", {}).items()
        }
        got.setdefault("separator", "," if kind == "csv" else "\t")
        # named columns mean a file without a header, unless ``skip`` passes over one
        got["has_header_row"] = not got.get("columns")
        return cls(**got)

    def with_options(self, **changes) -> "FileControl":
        return replace(self, **changes)

    def all_formats(self) -> list[str]:
        """Every time format the control mentions, each once."""
        seen = dict.fromkeys(self.floating_timestamp_format + self.fixed_timestamp_format)
        for override in self.overrides.values():
            seen.update(dict.fromkeys(override.timestamp_format or []))
        return list(seen)

    def for_column(self, name: str) -> "ColumnOptions":
        """Options in force for one column: its override, else the file's."""
        o = self.overrides.get(name, ColumnOverride())

        def pick(own, general):
            return general if own is None else own

        return ColumnOptions(
            trim=pick(o.trim_whitespace, self.trim_whitespace),
            trim_stored=pick(o.trim_server_whitespace, self.trim_server_whitespace),
            empty_is_null=pick(o.empty_text_is_null, self.empty_text_is_null),
            floating_formats=pick(o.timestamp_format, self.floating_timestamp_format),
            fixed_formats=pick(o.timestamp_format, self.fixed_timestamp_format),
            timezone=pick(o.timezone, self.timezone),
        )


@dataclass(frozen=True)
class ColumnOptions:
    trim: bool
    trim_stored: bool
    empty_is_null: bool
    floating_formats: list[str]
    fixed_formats: list[str]
    timezone: str


@dataclass(frozen=True)
class Control:
    """A whole control file."""

    action: str | None = None
    opaque: str | None = None
    csv: FileControl | None = None
    tsv: FileControl | None = None

    @property
    def file(self) -> FileControl:
        """The block in force; ``csv`` wins where both are given."""
        block = self.csv or self.tsv
        if block is None:
            raise ControlError("a control file needs a csv or a tsv block")
        return block


def parse_control(text: str) -> Control:
    """Read control JSON. Unknown keys are allowed at the top, not inside a block."""
    try:
        raw = json.loads(text)
    except json.JSONDecodeError as e:
        raise ControlError(f"control file is not valid JSON: {e}") from e
    if not isinstance(raw, dict):
        raise ControlError("control file: expected an object")
    blocks = {
        kind: FileControl.parse(raw[kind], kind)
        for kind in ("csv", "tsv")
        if raw.get(kind) is not None
    }
    return Control(raw.get("action"), raw.get("opaque"), blocks.get("csv"), blocks.get("tsv"))


def generate_control(
    file_name: str,
    action: str,
    columns: list[str] | None = None,
    use_geocoding: bool = False,
    has_header_row: bool = True,
    time_formats=DEFAULT_TIME_FORMATS,
) -> Control:
    """The control file a job gets when it brings none."""
    is_csv = file_name.lower().endswith(".csv")
    block = FileControl(
        separator="," if is_csv else "\t",
        quote='"' if is_csv else NO_QUOTE,
        columns=list(columns) if columns else None,
        floating_timestamp_format=list(time_formats),
        fixed_timestamp_format=list(time_formats),
        use_geocoding=use_geocoding,
        column_statistics=action.lower() == "replace",
        has_header_row=has_header_row,
    )
    title = action[:1].upper() + action[1:]
    return Control(title, None, block if is_csv else None, None if is_csv else block)


def control_json(control: Control) -> dict:
    """The control file as plain JSON values, keys sorted, unset options left out."""

    def plain(value):
        if isinstance(value, Synthetic):
            typed = {} if value.kind == "location" else {"type": value.kind}
            return dict(sorted((value.parts | typed).items()))
        if isinstance(value, (FileControl, ColumnOverride)):
            items = {
                _camel(f.name): plain(getattr(value, f.name))
                for f in fields(value)
                if not f.metadata.get("hidden") and getattr(value, f.name) is not None
            }
            if isinstance(value, FileControl):
                for optional in ("syntheticLocations", "syntheticPoints", "columnStatistics"):
                    if not items.get(optional):
                        items.pop(optional, None)
            return dict(sorted(items.items()))
        if isinstance(value, dict):
            return {k: plain(v) for k, v in sorted(value.items())}
        return value

    out = {"action": control.action, "opaque": control.opaque,
           "csv": plain(control.csv), "tsv": plain(control.tsv)}
    return {k: v for k, v in sorted(out.items()) if v is not None}


def check_formats(control: FileControl) -> list[str]:
    """Messages about time formats that cannot be read; empty when all is well."""
    problems = []
    for pattern in control.all_formats():
        try:
            translate_all([pattern])
        except UnsupportedPattern as e:
            problems.append(f"Unsupported Date Time Format: {e}")
    return problems


# Charsets Spark reads as it comes; any other needs spark.sql.legacy.javaCharsets.
CHARSETS = ("iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8")


def check_encoding(control: FileControl, java_charsets: bool = False) -> list[str]:
    """Messages about a charset that cannot be read; no encoding at all is fine."""
    name = (control.encoding or "utf-8").lower()
    if name in CHARSETS:
        return []
    try:
        codecs.lookup(name)
    except LookupError:
        return [f"Unsupported Encoding: The encoding '{control.encoding}' is not supported."]
    if java_charsets:
        return []
    return [
        f"Unsupported Encoding: The encoding '{control.encoding}' needs "
        "spark.sql.legacy.javaCharsets=true"
    ]


def check_action(
    action: str | None,
    row_identifier: str | None,
    requested: str | None = None,
    job: str = "publish",
) -> list[str]:
    """Rules about the publishing method of one job."""
    known = (action or "").lower()
    if known not in ACTIONS:
        return ["Unknown Publish Method: the 'action' option must be one of " + ", ".join(ACTIONS)]
    problems = []
    if requested and requested.lower() != known:
        problems.append(
            f"Conflicting Publish Methods: '{requested}' was asked for, "
            f"but the control file says '{action}'"
        )
    if known == "delete" and row_identifier is None:
        problems.append("Dataset Requirement Unfulfilled: to delete, a row identifier must be set")
    allowed = {"port": ("upsert", "replace"), "gis": ("replace",)}.get(job, ACTIONS)
    if known not in allowed:
        problems.append(f"A {job} job cannot use the publish method '{known}'")
    return problems


@dataclass(frozen=True)
class PortControl:
    """What a copy job copies, and where to."""

    source_dataset: str
    destination_name: str | None
    copy: str  # schema, data or all
    publish: bool = True


def parse_port_control(text: str) -> PortControl:
    """Read the control JSON of a copy job; keys nobody knows are allowed."""
    try:
        raw = json.loads(text)
    except json.JSONDecodeError as e:
        raise ControlError(f"control file is not valid JSON: {e}") from e
    kind = (raw.get("copyType") or {}).get("type")
    copy = {"schema": "schema", "data": "data", "schema_and_data": "all"}.get(kind)
    if copy is None or not raw.get("sourceDataset"):
        raise ControlError(f"unknown copy type '{kind}', or no source dataset")
    return PortControl(
        raw["sourceDataset"], raw.get("destinationName"), copy, raw.get("publish", True) is not False
    )
