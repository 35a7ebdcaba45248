"""Tabular files: every column is text, empty cells are empty text, headers have single spaces.

Codes have leading zeros, so nothing is inferred. A delimiter belongs to a source. Row order matters to some
operators and Spark has none, so the scans that promise it give a position column.
"""

from __future__ import annotations

import csv
import io
import itertools
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.functions import arrays, dates


def normal_header(name: str) -> str:
    """White space of any kind, ends too, becomes single spaces."""
    return " ".join(name.split())


def normalise_headers(rows: DataFrame, aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Columns renamed by normal_header, then by the aliases of old headers; clashing names get _2, _3 .."""
    names, seen = [], {}
    for name in rows.columns:
        new = normal_header(name)
        new = (aliases or {}).get(new, new)
        seen[new] = seen.get(new, 0) + 1
        names.append(new if seen[new] == 1 else f"{new}_{seen[new]}")
    return rows.toDF(*names)


def filled(rows: DataFrame) -> DataFrame:
    """Null text is empty text."""
    return rows.na.fill("")


def read_csv(spark: SparkSession, path: str | Sequence[str], sep: str = ",", aliases: Mapping[str, str] | None = None, recursive: bool = False) -> DataFrame:
    """Header CSV as text; quoted cells may hold line ends. A missing path raises AnalysisException."""
    reader = spark.read.option("header", True).option("sep", sep).option("multiLine", True).option("escape", '"').option("inferSchema", False)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return filled(normalise_headers(reader.csv(path), aliases))


def with_position(rows: DataFrame, name: str = "pos") -> DataFrame:
    """Position of rows of one unsplit file, as scanned. Across files, order by the path as well."""
    return rows.withColumn(name, F.monotonically_increasing_id())


def keep_last(rows: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in ``order``, which has to be total."""
    last = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.desc(c) for c in order]))
    return rows.withColumn("__nth", last).where("__nth = 1").drop("__nth")


def keyed_csv(spark: SparkSession, path: str, key: str, where: Column | None = None, sep: str = ",") -> DataFrame:
    """Rows that ``where`` lets through, one for each key: the last in the file."""
    rows = with_position(read_csv(spark, path, sep))
    return keep_last(rows if where is None else rows.where(where), [key], ["pos"]).drop("pos")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed lines that aren't empty: deny-lists, covered dates."""
    line = F.trim(F.col("value")).alias("line")
    return spark.read.text(path).select(line).where("line != ''").distinct()


def read_cells(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """Headerless CSV as (file, pos, cells), rows as wide as they were written; quoted cells may hold line ends.

    Each file is read whole, as its rows need their order; these files are pages of documents, small ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            for file, text in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows = enumerate(csv.reader(io.StringIO(text or "", newline=""), delimiter=sep))
                while part := [(at, cells) for at, cells in itertools.islice(rows, 4000)]:
                    kept = [(at, cells) for at, cells in part if cells]
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(kept), pa.string()), pa.array([at for at, _ in kept], pa.int64()), pa.array([cells for _, cells in kept], pa.list_(pa.string()))], names=["file", "pos", "cells"])

    pages = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    return pages.mapInArrow(run, "file string, pos long, cells array<string>")


def with_header(rows: DataFrame, span: int = 1, cells: str = "cells", order: str = "pos") -> DataFrame:
    """Positional rows -> named columns, by the first ``span`` rows: their cells joined with line ends, normalised; short
    header rows are padded. Short rows are padded, long ones cut. No rows beyond the header: an empty table. ``order`` has
    to be total; only the header's rows are sorted out."""
    if span < 1:
        raise ValueError("a header has one row at least")
    first = rows.orderBy(order).select(cells, order).limit(span).collect()
    head = [r[0] for r in first]
    width = max(map(len, head), default=0)
    names = [normal_header("\n".join(r[i] if i < len(r) else "" for r in head)) for i in range(width)]
    body = rows.where(F.col(order) > first[-1][1]) if first else rows
    fit = arrays.to_width(F.col(cells), width) if width else F.array()
    return normalise_headers(body.select(*[fit[i].alias(n or f"column {i + 1}") for i, n in enumerate(names)]))


def read_json(spark: SparkSession, path: str | Sequence[str], schema: str | None = None, lines: bool = False) -> DataFrame:
    """Files of JSON arrays, or of JSON lines, with the file's path in ``file``."""
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema else reader).json(path).withColumn("file", F.input_file_name())


def path_part(file: Column, from_end: int) -> Column:
    """Part of a path counted from its end: 0 is the file's stem, 1 its folder .."""
    parts = F.split(file, "/")
    name = F.try_element_at(parts, F.lit(-1 - from_end))
    name = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(name, r"\.[^.]+$", "") if from_end == 0 else name


def with_path_columns(rows: DataFrame, parts: Mapping[str, int], first: Sequence[str] = ()) -> DataFrame:
    """Columns from the path of ``file``, then columns ``first``, then the rest."""
    named = rows.select("*", *[path_part(F.col("file"), k).alias(n) for n, k in parts.items()])
    front = [*parts, *first]
    return named.select(*front, *[c for c in rows.columns if c not in front and c != "file"])


def latest_folder(spark: SparkSession, folder: str, pattern: str = dates.COMPACT) -> str | None:
    """The folder whose name is the latest date; other names don't count. Listed by Hadoop, on any store."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = [(s.getPath().getName(),) for s in found if s.isDirectory()]
    if not names:
        return None
    day = dates.parse(F.col("name"), pattern)
    row = spark.createDataFrame(names, "name string").agg(F.max_by("name", day).alias("name")).first()
    return f"{folder}/{row['name']}" if row["name"] else None


def literal_table(spark: SparkSession, text: str, sep: str = "\t") -> DataFrame:
    """A table written out in code: a header line, then rows."""
    head, *rows = [line.split(sep) for line in text.strip("\n").split("\n")]
    return normalise_headers(spark.createDataFrame([[*r, *[""] * (len(head) - len(r))][: len(head)] for r in rows], ", ".join(f"`{h}` string" for h in head)))


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Catalog CSV (name, size, url; header dropped) -> component, date, day, monthly, name, size, url. The component
    ``changes`` has no date."""
    rows = spark.read.option("header", True).csv(path).toDF("name", "size", "url")
    parts = F.split("name", r"\.")
    date = F.when(parts[0] != "changes", F.try_element_at(parts, F.lit(2)))
    monthly = date.rlike("^[A-Za-z]{3}[0-9]{4}$")
    day = F.coalesce(dates.parse(date, dates.COMPACT), dates.parse(F.concat(F.lit("01"), date), dates.COMPACT))
    return rows.select(parts[0].alias("component"), date.alias("date"), day.alias("day"), F.coalesce(monthly, F.lit(False)).alias("monthly"), "name", F.col("size").try_cast("bigint").alias("size"), "url")


SITE_MAP = "comp string, file string, desc string, fields map<string,struct<description:string>>, dropdown array<string>"


def read_site_map(spark: SparkSession, path: str, ignored: str = "IGNORE", by_file: bool = False) -> DataFrame:
    """Source catalog: rows with a component that isn't ignored (``by_file``: with a file, and ignored ones that
    have fields too)."""
    rows = spark.read.schema(SITE_MAP).option("multiLine", True).json(path)
    named = rows.where("coalesce(comp, '') != ''")
    if by_file:
        return named.where((F.coalesce("file", F.lit("")) != "") & ((F.col("comp") != ignored) | F.col("fields").isNotNull()))
    return named.where(F.col("comp") != ignored)


Transform = Callable[[DataFrame], DataFrame]
_TRANSFORMS: dict[str, Callable[..., Transform]] = {}


def register(name: str) -> Callable[[Callable[..., Transform]], Callable[..., Transform]]:
    """Makes a function of arguments that returns a table transform known by name."""

    def add(make: Callable[..., Transform]) -> Callable[..., Transform]:
        _TRANSFORMS[name] = make
        return make

    return add


def named_transform(name: str, *arguments) -> Transform:
    if name not in _TRANSFORMS:
        raise KeyError(f"no transform is named {name}; there are {sorted(_TRANSFORMS)}")
    return _TRANSFORMS[name](*arguments)


@register("identity")
def _identity() -> Transform:
    return lambda rows: rows


@register("ignore_if_empty_field")
def _ignore_if_empty(field: str) -> Transform:
    return lambda rows: rows.where(F.coalesce(F.col(f"`{field}`"), F.lit("")) != "")


def skip_then_header(rows: DataFrame, skip: int, span: int = 1, cells: str = "cells", order: str = "pos") -> DataFrame:
    """Sheets with lines before their header: the first ``skip`` rows go, then with_header."""
    before = rows.orderBy(order).select(order).limit(skip).collect()
    return with_header(rows.where(F.col(order) > before[-1][0]) if before else rows, span, cells, order)


STATE_CONFIG = "state string, suffix string, class bigint, alternates array<bigint>"


def state_config(rows: DataFrame) -> DataFrame:
    """A user's table of states (STATE_CONFIG), checked: a state without a name or given twice, or without a class, raises."""
    kinds = dict(rows.dtypes)
    if lacking := [c for c in ("state", "suffix", "class", "alternates") if c not in kinds]:
        raise ValueError(f"state configuration lacks {lacking}")
    bad = rows.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("class").isNull()).alias("none")).where("n > 1 or none or coalesce(state, '') = ''")
    if wrong := [r["state"] for r in bad.orderBy("state").limit(20).collect()]:
        raise ValueError(f"state configuration is wrong for {wrong}")
    return rows.select("state", F.coalesce("suffix", F.lit("")).alias("suffix"), "class", F.coalesce("alternates", F.array().cast("array<bigint>")).alias("alternates"))


def state_classes(config: DataFrame) -> DataFrame:
    """state, class: a row for each class that a state's entities may have, alternates too."""
    return config.select("state", F.explode(F.array_union(F.array("class"), "alternates")).alias("class"))
