"""Field extraction from JSON works (X1-X15, S2): path patterns to long rows of field, concrete path and value.

A list of patterns is compiled into one tree of steps, so a work is parsed and walked once for all of them.  Lines come
from ``sources.works``; a partition of lines is parsed in Arrow batches, and nothing is shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..schemas import EAV_DOI, EAV_WORK
from ..sources.registry import DOI_ARRAYS, WORK_ARRAYS

EACH, ANY = "[]", "*"


def parse_fields(listed: str) -> list[tuple[str, ...]]:
    """Comma-separated patterns of dot-separated steps; blanks and empty parts go, an empty list is an error."""
    patterns = [tuple(step.strip() for step in part.split(".") if step.strip()) for part in listed.split(",")]
    patterns = [p for p in patterns if p]
    if not patterns:
        raise ValueError("no field to extract")
    return patterns


@dataclass
class Step:
    """A place in the tree: patterns that end here, and where each key, any key, or each element leads."""

    ends: list[str] = field(default_factory=list)
    next: dict[str, Step] = field(default_factory=dict)

    def to(self, key: str) -> Step:
        return self.next.setdefault(key, Step())


def compile_patterns(patterns: list[tuple[str, ...]], arrays: frozenset[str], wildcard_heads: tuple[str, ...] = ()) -> Step:
    """The tree of all patterns.

    Behind a prefix that is an array comes a step over its elements.  A pattern given twice ends twice.  For a head in
    ``wildcard_heads`` the pattern ``head.*`` joins in, once, and gives rows of its own.
    """
    wanted = list(patterns)
    for head in wildcard_heads:
        if any(p[0] == head for p in patterns) and (head, ANY) not in wanted:
            wanted.append((head, ANY))
    root = Step()
    for pattern in wanted:
        at = root
        for n, key in enumerate(pattern, 1):
            at = at.to(key)
            if ".".join(pattern[:n]) in arrays:
                at = at.to(EACH)
        at.ends.append(".".join(pattern))
    return root


def _number(value: float) -> str:
    """A float as JSON writers of the shortest round-trip form print it: plain from 1e-5 to below 1e16."""
    mantissa, _, exponent = f"{value!r}".replace("+", "").partition("e")
    sign, mantissa = ("-", mantissa[1:]) if mantissa.startswith("-") else ("", mantissa)
    whole, _, fraction = mantissa.partition(".")
    point = len(whole) + int(exponent or 0)
    digits = (whole + fraction).lstrip("0")
    point -= len(whole + fraction) - len(digits)
    digits = digits.rstrip("0")
    if not digits:
        return sign + "0.0"
    if 0 < point <= 16:
        return sign + digits.ljust(point, "0")[:point] + "." + (digits[point:] or "0")
    if -5 < point <= 0:
        return sign + "0." + "0" * -point + digits
    return sign + digits[0] + ("." + digits[1:] if len(digits) > 1 else "") + f"e{point - 1}"


def _json(value: Any) -> str:
    """Compact JSON with sorted keys."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{_json(value[k])}" for k in sorted(value)) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(_json, value)) + "]"
    if isinstance(value, float):
        return _number(value)
    return json.dumps(value, ensure_ascii=False)


def rendered(value: Any) -> str:
    """Strings as they are, null as '', everything else as compact JSON."""
    if isinstance(value, str):
        return value
    return "" if value is None else _json(value)


def walk(value: Any, step: Step, path: str = "") -> Iterator[tuple[str, str, str]]:
    """(pattern, concrete path, value), a place before what lies below it."""
    if step.ends:
        text = rendered(value)
        for name in step.ends:
            yield name, path, text
    if not step.next:
        return
    if isinstance(value, dict):
        for key in sorted(value):
            below = f"{path}.{key}" if path else key
            for way in (key, ANY):
                # "*" as an actual key meets both ways, too
                if way in step.next:
                    yield from walk(value[key], step.next[way], below)
    elif isinstance(value, list) and EACH in step.next:
        for i, item in enumerate(value):
            yield from walk(item, step.next[EACH], f"{path}[{i}]")


def _whole(text: str) -> int | float:
    """Whole numbers beyond 64 bits are floats."""
    n = int(text)
    return n if -(1 << 63) <= n < 1 << 64 and text != "-0" else float(n) if text != "-0" else -0.0


def _refuse(text: str) -> None:
    raise ValueError(text)


def parse_line(line: str) -> Any:
    """The value of a line, or None where it is no JSON."""
    try:
        return json.loads(line, parse_int=_whole, parse_constant=_refuse)
    except (ValueError, RecursionError):
        return None


def _at(value: Any, *keys: str) -> Any:
    for key in keys:
        value = value.get(key) if isinstance(value, dict) else None
    return value


def _string(value: Any) -> str | None:
    return value if isinstance(value, str) else None


def _before_slash(doi: str | None) -> str | None:
    return doi.partition("/")[0] if doi and "/" in doi else None


class Keys(NamedTuple):
    """What identifies a work: its keys, and the source or member and DOI prefix that filters look at."""

    work_id: str | None
    doi: str | None
    group: str | None
    prefix: str | None


def work_keys(work: Any) -> Keys:
    """X9, X10, X12, X13."""
    doi = _string(_at(work, "doi"))
    doi = doi.removeprefix("https://doi.org/") if doi is not None else None
    return Keys(_string(_at(work, "id")), doi, _string(_at(work, "primary_location", "source", "id")), _before_slash(doi))


def doi_keys(work: Any) -> Keys:
    """The member may be a number; the prefix field comes before the DOI's own."""
    doi, member = _string(_at(work, "DOI")), _at(work, "member")
    if isinstance(member, (int, float)) and not isinstance(member, bool):
        member = rendered(member)
    prefix = _string(_at(work, "prefix"))
    return Keys(None, doi, _string(member), prefix if prefix is not None else _before_slash(doi))


@dataclass(frozen=True)
class Flavour:
    """One of the two vocabularies of works."""

    arrays: frozenset[str]
    wildcard_heads: tuple[str, ...]
    keys: Callable[[Any], Keys]
    required: tuple[str, ...]


WORK = Flavour(WORK_ARRAYS, (), work_keys, ("work_id",))
DOI = Flavour(DOI_ARRAYS, ("relation",), doi_keys, ("doi", "group"))
#: The fields that ``operators.normalize`` needs.
PIPELINE_FIELDS = ",".join([
    "authorships.author.display_name", "authorships.affiliations.raw_affiliation_string", "authorships.affiliations.institution_ids",
    "authorships.institutions.id", "authorships.institutions.ror",
])


def _passes(keys: Keys, flavour: Flavour, group: str | None, prefix: str | None) -> bool:
    """X14, then the required keys."""
    return (group is None or keys.group == group) and (prefix is None or keys.prefix == prefix) and all(getattr(keys, k) is not None for k in flavour.required)


def extract(lines: DataFrame, fields: str | list[tuple[str, ...]], flavour: Flavour = WORK, group: str | None = None, prefix: str | None = None) -> DataFrame:
    """Rows of ``EAV_WORK`` or ``EAV_DOI`` from a DataFrame with the columns line and source_file_path.

    ``group`` keeps one source (or member), ``prefix`` one DOI prefix.  Blank and broken lines, works without their
    required keys and works without any of the fields give no rows (X15).
    """
    tree = compile_patterns(parse_fields(fields) if isinstance(fields, str) else fields, flavour.arrays, flavour.wildcard_heads)
    schema = EAV_WORK if flavour is WORK else EAV_DOI
    kinds = pa.schema([(name, pa.string()) for name in schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for line, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                work = parse_line(line) if line and line.strip() else None
                if work is None:
                    continue
                keys = flavour.keys(work)
                if not _passes(keys, flavour, group, prefix):
                    continue
                head = (keys.work_id, keys.doi or "") if flavour is WORK else (keys.doi,)
                tail = (keys.group or "", keys.prefix or "", source) if flavour is WORK else (keys.group, keys.prefix or "")
                rows += [(*head, *found, *tail) for found in walk(work, tree)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows, strict=True)], schema=kinds)

    return lines.select("line", "source_file_path").mapInArrow(run, schema)


_FOUND = "array<struct<field_name:string,subfield_path:string,value:string>>"


def _rows_of(step: Step, value: Column, path: Column | None = None) -> Column:
    """The rows of a place and below it as an array of (field_name, subfield_path, value); NULL where there is no value."""
    parts = []
    if step.ends:
        shown = F.coalesce(F.try_variant_get(value, "$", "string"), F.lit(""))
        parts.append(F.array(*(F.struct(F.lit(n).alias("field_name"), path.alias("subfield_path"), shown.alias("value")) for n in step.ends)))
    for key, child in step.next.items():
        if key == EACH:
            items = F.try_variant_get(value, "$", "array<variant>")
            below = lambda i: F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))
            found = F.flatten(F.transform(items, lambda item, i: _rows_of(child, item, below(i))))  # noqa: B023
        else:
            below = F.lit(key) if path is None else F.concat(path, F.lit(f".{key}"))
            found = _rows_of(child, _member(value, key), below)
        parts.append(F.coalesce(found, F.array().cast(_FOUND)))
    return F.when(value.isNotNull(), parts[0] if len(parts) == 1 else F.concat(*parts))


def _member(value: Column, *keys: str) -> Column:
    return F.try_variant_get(value, "$" + "".join(f"[{json.dumps(k, ensure_ascii=False)}]" for k in keys), "variant")


def _string_at(value: Column, *keys: str) -> Column:
    """The string at a path, or NULL where there is none or something else."""
    found = _member(value, *keys)
    return F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))


def extract_jvm(lines: DataFrame, fields: str | list[tuple[str, ...]], group: str | None = None, prefix: str | None = None) -> DataFrame:
    """``extract`` of works with a work id, for patterns without wildcards, on the JVM: one parse of a line and one walk.

    Strings, null, booleans and whole numbers are rendered as by ``extract``; fractions and nested values as Spark prints
    them, and a line that repeats a key within an object counts as broken, which are the differences.
    """
    patterns = parse_fields(fields) if isinstance(fields, str) else fields
    if any(ANY in p for p in patterns):
        raise ValueError("wildcards need extract()")
    tree = compile_patterns(patterns, WORK.arrays)
    work = lines.select(F.try_parse_json("line").alias("w"), "source_file_path").where("w is not null")
    doi = text.doi_of_url(F.coalesce(_string_at(F.col("w"), "doi"), F.lit("")))
    rows = work.select(
        _string_at(F.col("w"), "id").alias("work_id"), doi.alias("doi"), _string_at(F.col("w"), "primary_location", "source", "id").alias("source_id"), "source_file_path", "w"
    ).where("work_id is not null")
    rows = rows.withColumn("doi_prefix", text.doi_prefix(F.col("doi")))
    if group is not None:
        rows = rows.where(F.col("source_id") == group)
    if prefix is not None:
        rows = rows.where(F.when(F.col("doi").contains("/"), F.col("doi_prefix")) == prefix)
    rows = rows.select("*", F.explode(_rows_of(tree, F.col("w"))).alias("f"))
    return rows.select("work_id", "doi", "f.*", F.coalesce("source_id", F.lit("")).alias("source_id"), "doi_prefix", "source_file_path").select(*EAV_WORK.names)


def line_report(lines: DataFrame, flavour: Flavour = WORK) -> DataFrame:
    """Per file: lines, blank lines, broken lines, works without their required keys, usable works."""
    names = ["blank", "broken", "missing_key", "usable"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = []
            for line in batch.column(0).to_pylist():
                if not line or not line.strip():
                    kinds.append("blank")
                    continue
                work = parse_line(line)
                kinds.append("broken" if work is None and line.strip() != "null" else "usable" if _passes(flavour.keys(work), flavour, None, None) else "missing_key")
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(kinds, pa.string())], names=["source_file_path", "kind"])

    kinds = lines.select("line", "source_file_path").mapInArrow(run, "source_file_path string, kind string")
    counts = [F.count_if(F.col("kind") == n).alias(n) for n in names]
    return kinds.groupBy("source_file_path").agg(F.count(F.lit(1)).alias("lines"), *counts)


def extract_native(source: DataFrame, json_column: str, paths: dict[str, str]) -> DataFrame:
    """Scalar fields of known object paths without Python: one row per field that the JSON text has, null included as ''.

    ``paths`` maps a field name to a path such as ``$.k``.  For strings and whole numbers the rendering is that of
    ``rendered``; for patterns that fan out, use ``extract``.
    """
    parsed = F.try_parse_json(F.col(json_column))
    present = [F.struct(F.lit(n).alias("field_name"), F.lit(p.removeprefix("$.")).alias("subfield_path"), _scalar(parsed, p).alias("value")) for n, p in paths.items()]
    return source.withColumn("_field", F.explode(F.filter(F.array(*present), lambda f: f["value"].isNotNull()))).select(*source.columns, "_field.*")


def _scalar(parsed: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
    return F.when(kind == "VOID", F.lit("")).otherwise(F.try_variant_get(parsed, path, "string"))
