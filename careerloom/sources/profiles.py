"""JSON text lines to profile rows, and the quarantine of lines that do not parse."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careerloom.functions import has_bad_year, is_blank, strip_blanks
from careerloom.schema import (
    POSITION_JSON_NAMES,
    POSITIONS_TYPE,
    PROFILE_COLUMNS,
    PROFILE_JSON_NAMES,
    profile_json_schema,
)

_JSON_OPTIONS = {"allowUnquotedFieldNames": "true"}

MALFORMED = "malformed"
OTHER_LAYOUT = "other_layout"
BAD_YEAR = "bad_year"
WRONG_TYPE = "wrong_type"
TRAILING_TEXT = "trailing_text"

_OPENING = {"array": "[", "object": "{"}


def _opens_with(line: Column, bracket: str) -> Column:
    return F.startswith(strip_blanks(line), F.lit(bracket))


def _is_skipped(line: Column) -> Column:
    """Lines that carry nothing and are no error: blank, or JSON null."""
    return is_blank(line) | (strip_blanks(line) == "null")


def _parsed(line: Column, layout: str, columns: Iterable[str] | None) -> Column:
    """Array of the profiles on a line, or null when the line is malformed.

    A single object is read as a list of one: Spark turns a malformed list into
    null, but a malformed object into a struct of nulls. A line that goes on after
    its object is malformed.
    """
    kind = T.ArrayType(profile_json_schema(columns))
    if layout != "object":
        return F.from_json(line, kind, _JSON_OPTIONS)
    listed = F.from_json(F.concat(F.lit("["), line, F.lit("]")), kind, _JSON_OPTIONS)
    one = F.filter(F.array(listed), lambda p: (F.size(p) == 1) & F.endswith(strip_blanks(line), F.lit("}")))
    return F.get(one, F.lit(0))


def _profile_fields(profile: str, columns: Iterable[str] | None) -> list[Column]:
    """Fields of the parsed struct under their column names; missing lists become empty."""
    fields = []
    for column in PROFILE_COLUMNS:
        if columns is not None and column not in columns:
            continue
        value = F.col(profile).getField(PROFILE_JSON_NAMES[column])
        if column == "positions":
            value = F.filter(value.cast(POSITIONS_TYPE), lambda p: p.isNotNull())
        if column in ("skills", "positions"):
            value = F.coalesce(value, F.array())
        fields.append(value.alias(column))
    return fields


def _read_profiles(
    lines: DataFrame, kept: list[str], line: Column, layout: str, columns: Iterable[str] | None
) -> DataFrame:
    columns = list(columns) if columns is not None else None
    # The parser runs inside explode, so no later filter makes it run again.
    return (
        lines.filter(_opens_with(line, _OPENING[layout]))
        .select(*kept, F.explode(_parsed(line, layout, columns)).alias("_profile"))
        .filter(F.col("_profile").isNotNull())
        .select(*kept, *_profile_fields("_profile", columns))
    )


def _variant_at(variant: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(variant, path, kind)


def _is_kind(variant: Column, *kinds: str) -> Column:
    """Whether a value is of one of these kinds of JSON; missing values and JSON null are of every kind."""
    found = F.coalesce(F.schema_of_variant(variant), F.lit("VOID"))
    return found.rlike(f"^(VOID|{'|'.join(kinds)})")


def _quoted(kind: T.DataType) -> str:
    """A type as text, with its names in quotes: JSON names have hyphens."""
    if isinstance(kind, T.ArrayType):
        return f"array<{_quoted(kind.elementType)}>"
    if isinstance(kind, T.StructType):
        return f"struct<{', '.join(f'`{f.name}`: {_quoted(f.dataType)}' for f in kind)}>"
    return kind.simpleString()


_TEXT = ("STRING", "BOOLEAN", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT")


def _fields_fit(value: Column, fields: dict[str, tuple[str, ...]]) -> Column:
    """Whether a value is an object whose fields are of these kinds."""
    fit = _is_kind(value, "OBJECT")
    for name, kinds in fields.items():
        fit &= _is_kind(_variant_at(value, f"$['{name}']"), *kinds)
    return fit


def _elements_fit(value: Column, fits) -> Column:
    """Whether a value is a list whose elements fit."""
    return _is_kind(value, "ARRAY") & F.forall(
        F.coalesce(_variant_at(value, "$", "array<variant>"), F.array().cast("array<variant>")), fits
    )


def _profile_fits(profile: Column) -> Column:
    """Whether all fields of a profile have their types, whatever columns are read."""
    names = {c: n for c, n in PROFILE_JSON_NAMES.items() if c not in ("skills", "positions", "relevant_experience")}
    position = {n: ("BOOLEAN", "STRING") if c == "is_current" else _TEXT for c, n in POSITION_JSON_NAMES.items()}
    experience = _variant_at(profile, f"$['{PROFILE_JSON_NAMES['relevant_experience']}']")
    return (
        _fields_fit(profile, dict.fromkeys(names.values(), _TEXT))
        & _elements_fit(_variant_at(profile, f"$['{PROFILE_JSON_NAMES['skills']}']"), lambda s: _is_kind(s, *_TEXT))
        & _elements_fit(
            _variant_at(profile, f"$['{PROFILE_JSON_NAMES['positions']}']"), lambda p: _fields_fit(p, position)
        )
        & (
            _is_kind(experience, "BIGINT")
            | (_is_kind(experience, "STRING") & _variant_at(experience, "$", "int").isNotNull())
        )
    )


def _outcome(line: Column, layout: str, columns: list[str] | None, strict: bool) -> Column:
    """(profiles, reason) of a line that isn't skipped, from one parse. Profiles are null if the line is dropped."""
    kind = profile_json_schema(columns)
    opens = _opens_with(line, _OPENING[layout])

    def bad_year(profiles: Column) -> Column:
        return F.exists(
            profiles, lambda p: F.coalesce(has_bad_year(p["positions"].cast(POSITIONS_TYPE)), F.lit(False))
        )

    def loose(parsed: Column) -> Column:
        reason = F.when(~opens, F.lit(OTHER_LAYOUT)).when(parsed.isNull(), F.lit(MALFORMED))
        return F.struct(
            F.when(opens, parsed).alias("profiles"),
            reason.when(bad_year(parsed), F.lit(BAD_YEAR)).alias("reason"),
        )

    def typed(wrapped: Column) -> Column:
        # The line is the only element of a list, or it goes on after its value.
        whole = F.when(F.size(wrapped) == 1, F.get(wrapped, F.lit(0)))
        if layout == "array":
            values = _variant_at(whole, "$", "array<variant>")
            profiles = _variant_at(whole, "$", f"array<{_quoted(kind)}>")
        else:
            values = F.array(whole)
            profiles = F.array(_variant_at(whole, "$", _quoted(kind)))
        goes_on = whole.isNull() & F.from_json(line, "variant", _JSON_OPTIONS).isNotNull()
        dropped = (
            F.when(~opens, F.lit(OTHER_LAYOUT))
            .when(goes_on, F.lit(TRAILING_TEXT))
            .when(whole.isNull(), F.lit(MALFORMED))
            .when(~F.forall(values, _profile_fits), F.lit(WRONG_TYPE))
        )
        return F.struct(
            F.when(dropped.isNull(), profiles).alias("profiles"),
            F.when(dropped.isNotNull(), dropped).when(bad_year(profiles), F.lit(BAD_YEAR)).alias("reason"),
        )

    # The one-element array binds the parsed value, so each line is parsed once.
    if not strict:
        return F.get(F.transform(F.array(_parsed(line, layout, columns)), loose), F.lit(0))
    wrapped = F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<variant>", _JSON_OPTIONS)
    return F.get(F.transform(F.array(wrapped), typed), F.lit(0))


def parse_lines(
    lines: DataFrame,
    line_col: str = "value",
    layout: str = "array",
    columns: Iterable[str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Profiles and rejects from one pass over the lines.

    A row for each profile, with reason null; and for each line that is dropped, or read with positions
    that are ignored, a row with its reason and the line as ``rejected_line``. Other columns of ``lines`` are
    carried along. :func:`profiles_of` and :func:`rejects_of` tell the two apart.

    ``strict`` drops the whole line when a value has the wrong type (an object or a list
    where text is expected, anything but a list of texts for skills, or of objects for positions, no
    whole number for the experience), or when text follows its value. Text fields take numbers and
    booleans as text, and null is of every type. Without ``strict``, such values become null and such text is ignored.
    """
    if layout not in _OPENING:
        raise ValueError("layout must be 'array' or 'object'")
    line, kept = F.col(line_col), [c for c in lines.columns if c != line_col]
    wanted = list(columns) if columns is not None else None
    parsed = None if wanted is None else [*wanted, *({"positions"} - set(wanted))]

    def outputs(outcome: Column) -> Column:
        empty = F.array().cast(T.ArrayType(profile_json_schema(parsed)))
        profiles = F.filter(F.coalesce(outcome["profiles"], empty), lambda p: p.isNotNull())
        none = F.lit(None).cast("string")
        good = F.transform(profiles, lambda p: F.struct(p.alias("profile"), none.alias("reason")))
        bad = F.filter(
            F.array(
                F.struct(F.lit(None).cast(profile_json_schema(parsed)).alias("profile"), outcome["reason"].alias("reason"))
            ),
            lambda r: r["reason"].isNotNull(),
        )
        return F.concat(good, bad)

    outcome = F.array(_outcome(line, layout, parsed, strict))
    rows = lines.filter(~_is_skipped(line)).select(
        *kept, line.alias("_line"), F.explode(F.flatten(F.transform(outcome, outputs))).alias("_row")
    )
    rows = rows.select(*kept, "_line", F.col("_row.reason").alias("reason"), F.col("_row.profile").alias("_profile"))
    return rows.select(
        *kept,
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("_line")).alias("rejected_line"),
        *_profile_fields("_profile", wanted),
    )


def profiles_of(parsed: DataFrame) -> DataFrame:
    """The profiles among the rows of :func:`parse_lines`."""
    return parsed.filter("reason IS NULL").drop("reason", "rejected_line")


def rejects_of(parsed: DataFrame) -> DataFrame:
    """(line, reason) of the rejected lines among the rows of :func:`parse_lines`."""
    return parsed.filter("reason IS NOT NULL").select(F.col("rejected_line").alias("line"), "reason")


def read_profile_arrays(
    lines: DataFrame, line_col: str = "value", columns: Iterable[str] | None = None, strict: bool = False
) -> DataFrame:
    """One row per profile from lines that each hold a JSON array of profiles.

    Blank lines, JSON null, malformed lines and null list elements give no row;
    :func:`rejected_lines` lists the malformed ones. Other columns of ``lines``
    are carried along. ``columns`` narrows what is parsed. ``strict`` also drops the lines
    with values of a wrong type, see :func:`parse_lines`.
    """
    if strict:
        return profiles_of(parse_lines(lines, line_col, "array", columns, strict=True))
    kept = [c for c in lines.columns if c != line_col]
    return _read_profiles(lines, kept, F.col(line_col), "array", columns)


def read_profile_objects(
    lines: DataFrame, line_col: str = "value", columns: Iterable[str] | None = None, strict: bool = False
) -> DataFrame:
    """One row per line that holds a single JSON profile; the raw line is kept."""
    if strict:
        carried = lines.withColumn("_value", F.col(line_col))
        return profiles_of(parse_lines(carried, line_col, "object", columns, strict=True)).withColumnRenamed(
            "_value", line_col
        )
    return _read_profiles(lines, lines.columns, F.col(line_col), "object", columns)


def rejected_lines(
    lines: DataFrame, line_col: str = "value", layout: str = "array", strict: bool = False
) -> DataFrame:
    """Quarantine table (line, reason) for lines a reader drops or reads only in part.

    ``layout`` is 'array' or 'object'. Reasons: malformed JSON, a line of the
    other layout, and (read, but with ignored positions) a year that cannot be
    read; with ``strict`` also a value of a wrong type, and text after the value. Blank lines
    and JSON null are skipped, not rejected.
    """
    if strict:
        return rejects_of(parse_lines(lines, line_col, layout, ["positions"], strict=True))
    if layout not in _OPENING:
        raise ValueError("layout must be 'array' or 'object'")
    line = F.col(line_col)

    def reason(parsed: Column) -> Column:
        bad_year = F.exists(
            parsed, lambda p: F.coalesce(has_bad_year(p["positions"].cast(POSITIONS_TYPE)), F.lit(False))
        )
        return (
            F.when(~_opens_with(line, _OPENING[layout]), F.lit(OTHER_LAYOUT))
            .when(parsed.isNull(), F.lit(MALFORMED))
            .when(bad_year, F.lit(BAD_YEAR))
        )

    # The one-element array binds the parsed value, so each line is parsed once.
    reasons = F.transform(F.array(_parsed(line, layout, ["positions"])), reason)
    return lines.filter(~_is_skipped(line)).select(
        line.alias("line"),
        F.explode(F.filter(reasons, lambda r: r.isNotNull())).alias("reason"),
    )


def with_profile_id(profiles: DataFrame, id_col: str = "pid") -> DataFrame:
    """Add a unique id per row; call it directly on a file scan.

    The number comes from the scan's partition and row order, so a lost task
    computes the same ids again. After a shuffle it would not: write the rows
    to a table with their ids before using them twice.
    """
    return profiles.withColumn(id_col, F.monotonically_increasing_id())
