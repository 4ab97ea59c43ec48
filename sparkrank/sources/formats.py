"""Collections in Parquet, JSON lines, tab-separated or plain text, with a declared mapping.

``read_collection(spark, path, format, columns)`` gives the columns that ``columns`` declares,
each as ``name: Field(source, type)``. ``source`` says where a value is:

* ``parquet``, ``json``: a column or a path of nested ones (``meta.id``);
* ``tsv``: the zero-based position, or the name when the files have a header line;
* ``text``: the number of a group of ``pattern`` in the line, or ``LINE`` for all of it.

Spark's own readers do the reading, so files are split, projections are pruned to the declared
columns and filters are pushed where the format can. Values are taken as text and cast: a value
that its type does not hold fails the job, as does a required field that is missing or null, a
line that is not JSON, a line with too few tabs, and a line that ``pattern`` does not match.
``Field(..., required=False)`` gives null for a missing one. Tabs beyond the last declared
position belong to that last field, quotes mean nothing. In ``tsv`` and ``text``, with
``escaped=True``, ``\\t``, ``\\n``, ``\\r`` and ``\\\\`` stand for the characters they name, which is
what ``write_lines`` writes. An empty folder gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = "line"
FORMATS = ("parquet", "json", "tsv", "text")
# Characters that lines cannot hold, and what is written for them.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


@dataclass(frozen=True)
class Field:
    source: str | int
    type: str = "string"
    required: bool = True


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    # Between doubled backslashes every backslash begins an escape.
    def part(x: Column) -> Column:
        for plain, written in ESCAPES[1:]:
            x = F.replace(x, F.lit(written), F.lit(plain))
        return x

    return F.array_join(F.transform(F.split(text, r"\\\\"), part), "\\")


def _checked(name: str, field: Field, value: Column) -> Column:
    cast = value.cast(field.type)  # ANSI: a value that the type does not hold fails
    if field.required:
        cast = F.coalesce(cast, F.raise_error(F.lit(f"line without {name}")).cast(field.type))
    return cast.alias(name)


def _json_schema(fields: list[Field]) -> str:
    tree: dict = {}
    for f in fields:
        at = tree
        *parents, leaf = str(f.source).split(".")
        for p in parents:
            at = at.setdefault(p, {})
        at[leaf] = None

    def ddl(node: dict, sep: str) -> str:
        return ", ".join(f"`{k}`{sep}" + ("string" if v is None else f"struct<{ddl(v, ':')}>") for k, v in node.items())

    return ddl(tree, " ")


def _path(source: str) -> Column:
    return F.col(".".join(f"`{p}`" for p in source.split(".")))


def read_collection(
    spark: SparkSession,
    path: str,
    format: str,
    columns: dict[str, Field],
    header: bool = False,
    pattern: str | None = None,
    escaped: bool = False,
) -> DataFrame:
    """The declared columns of every row below ``path`` (see the module's text)."""
    if format not in FORMATS:
        raise ValueError(f"unknown format {format}: one of {', '.join(FORMATS)}")
    fields = list(columns.values())
    if format == "parquet":
        rows = spark.read.parquet(path)
        return rows.select(*(_checked(n, f, _path(str(f.source))) for n, f in columns.items()))
    if format == "json":
        rows = spark.read.schema(_json_schema(fields)).option("mode", "FAILFAST").json(path)
        return rows.select(*(_checked(n, f, _path(str(f.source))) for n, f in columns.items()))
    plain = unescape if escaped else (lambda c: c)
    if format == "tsv":
        return _tsv(spark, path, columns, header, plain)
    lines = spark.read.text(path)
    if any(f.source != LINE for f in fields):
        if pattern is None:
            raise ValueError("groups of lines need a pattern")
        if re.compile(pattern).groups < max(int(f.source) for f in fields if f.source != LINE):
            raise ValueError("the pattern has fewer groups than asked for")
        wrong = F.raise_error(F.concat(F.lit("line without the pattern: "), F.col("value"))).cast("string")
        lines = lines.select(F.when(F.col("value").rlike(pattern), F.col("value")).otherwise(wrong).alias("value"))
    group = lambda f: F.col("value") if f.source == LINE else F.regexp_extract("value", pattern, int(f.source))
    return lines.select(*(_checked(n, f, plain(group(f))) for n, f in columns.items()))


def _tsv(spark: SparkSession, path: str, columns: dict[str, Field], header: bool, plain) -> DataFrame:
    lines = spark.read.text(path)
    places = {n: f.source for n, f in columns.items()}
    if header:
        first = lines.first()  # every file begins with the same line
        names = first["value"].split("\t") if first else [str(p) for p in places.values()]
        lines = lines.where(F.col("value") != (first["value"] if first else ""))
        places = {n: names.index(str(p)) for n, p in places.items()}
    last = max(int(p) for p in places.values())
    # With a header each column is a field of its own; without one the last field takes the rest.
    parts = F.split("value", "\t", -1 if header else last + 1)
    optional = {int(places[n]) for n, f in columns.items() if not f.required}
    need = max((int(p) for p in places.values() if int(p) not in optional), default=-1) + 1
    wrong = F.raise_error(F.concat(F.lit("line with too few tabs: "), F.col("value"))).cast("array<string>")
    rows = lines.select(F.when(F.size(parts) >= need, parts).otherwise(wrong).alias("p"))
    return rows.select(*(_checked(n, f, plain(F.get("p", F.lit(int(places[n]))))) for n, f in columns.items()))


def write_lines(rows: DataFrame, path: str, separator: str = "\t", compression: str = "none") -> None:
    """Rows as escaped lines; a null value is written as an empty one."""
    cells = [escape(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in rows.columns]
    rows.select(F.concat_ws(separator, *cells).alias("value")).write.text(path, compression=compression)
