"""Reading delimited text, GeoJSON features, sheets and Parquet; writing extracts."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanweave.functions.geometry import parse_parts, parse_point
from urbanweave.operators.reshape import quoted, union_by_name
from urbanweave.session import cut_lineage


def scan_delimited(spark: SparkSession, path: str, names: Sequence[str], sep: str = "\t",
                   row_number: str | None = "row_in_file", mixed_layouts: bool = False, glob: str = "*.csv") -> DataFrame:
    """All files below ``path`` as text columns plus ``file_path``, matched by column name.

    The first, unnamed column is the row number in the file and is returned as ``row_number`` (None: there
    is no such column). With an explicit schema Spark matches CSV by position; a file whose header
    differs therefore fails here, unless ``mixed_layouts`` is set: then the first line of each file is its header (one more
    pass over the text), the files of each layout are scanned with its schema, and missing columns become null. A file whose
    header has none of the names is an error, not data.
    """
    def read(columns: Sequence[str], checked: bool, paths: str | list[str]) -> DataFrame:
        # The header check compares names, so the row number keeps its empty name while files are read.
        schema = T.StructType([T.StructField("" if c == row_number else c, T.StringType()) for c in columns])
        raw = (
            spark.read.schema(schema).option("sep", sep).option("header", True).option("enforceSchema", not checked)
            .option("recursiveFileLookup", True).option("pathGlobFilter", glob).csv(paths).toDF(*columns)
        )
        number = [F.col(row_number).cast("long").alias(row_number)] if row_number else []
        kept = [quoted(c) for c in columns if c in names]
        return raw.select(*kept, *number, F.col("_metadata.file_path").alias("file_path"))

    lead = [row_number] if row_number else []
    if not mixed_layouts:
        return read([*lead, *names], True, path)

    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    placed = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                          F.monotonically_increasing_id().alias("line"))
    first = placed.where("at = 0").groupBy("file").agg(F.min_by("value", "line").alias("header"))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for file, header in first.collect():  # one row per file, as Spark's own listing
        columns = [c.strip('"') for c in header.split(sep)]
        columns = [*lead, *columns[len(lead):]]
        if not set(columns) & set(names):
            raise ValueError(f"{file}: the header has none of the expected columns")
        layouts.setdefault(tuple(columns), []).append(_as_path(file))
    if not layouts:
        return read([*lead, *names], True, path)
    # Names in their order; a layout may have them in another, or lack some.
    parts = [read(columns, False, sorted(files)) for columns, files in sorted(layouts.items())]
    missing = [n for n in names if not any(n in columns for columns in layouts)]
    return union_by_name(parts).withColumns({n: F.lit(None).cast("string") for n in missing}).select(
        *[quoted(n) for n in names], *lead, "file_path")


def _as_path(uri: str) -> str:
    """The path of a file URI, with the characters that patterns are made of escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def scan_geojson(spark: SparkSession, path: str, properties: T.StructType, lines: bool = False) -> DataFrame:
    """One row per feature: ``properties`` (struct), ``geometry(type, coordinates)`` with coordinates as JSON text, without blanks
    unless read by lines.

    ``lines=True`` reads newline-delimited features. Else files are FeatureCollections, and a large one is read by many tasks: see
    :func:`split_features`. Objects of a collection that aren't of type ``Feature`` are passed over.
    """
    feature = T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", properties),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType()),
        ])),
    ])
    if lines:
        return spark.read.option("recursiveFileLookup", True).schema(feature).json(path).select("properties", "geometry")
    parsed = split_features(spark, path).select(F.from_json("feature", feature).alias("f")).where("f.type = 'Feature'")
    return parsed.select("f.properties", "f.geometry")


#: What matters to the nesting of JSON: strings, one that isn't closed yet, and braces; and the rest of a string.
_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*(?:"|\Z)|[{}]', re.S)
_JSON_REST = re.compile(r'(?:[^"\\]|\\.)*"', re.S)
#: Parts of a feature: all of it, its beginning, its end, and what lies between.
_WHOLE, _HEAD, _TAIL, _MIDDLE = range(4)


class _Objects:
    """Objects of the second level in a stretch of JSON text that begins inside a string or not, at some depth."""

    def __init__(self, inside: bool, depth: int):
        self.inside, self.depth, self.text, self.at = inside, depth, "", 0
        self.begin: int | None = 0 if depth > 1 else None
        self.opened = False  # here, not before

    def feed(self, more: str) -> Iterator[tuple[int, str]]:
        self.text += more
        if self.inside:
            rest = _JSON_REST.match(self.text, self.at)
            if not rest:
                return
            self.inside, self.at = False, rest.end()
        end = len(self.text)
        for token in _JSON_TOKEN.finditer(self.text, self.at):
            mark = token.group()
            if mark == "{":
                self.depth += 1
                if self.depth == 2:
                    self.begin, self.opened = token.start(), True
            elif mark == "}":
                self.depth -= 1
                if self.depth == 1 and self.begin is not None:
                    yield _WHOLE if self.opened else _TAIL, self.text[self.begin:token.end()]
                    self.begin = None
            elif len(mark) == 1 or mark[-1] != '"' or _open_string(mark):
                end = token.start()
                break
        self.at = end
        kept = end if self.begin is None else self.begin
        self.text, self.at = self.text[kept:], self.at - kept
        if self.begin is not None:
            self.begin = 0

    def rest(self) -> Iterator[tuple[int, str]]:
        if self.begin is not None:
            yield _HEAD if self.opened else _MIDDLE, self.text


def _open_string(mark: str) -> bool:
    """Whether the last quote of a string is an escaped one."""
    body = mark[1:-1]
    return (len(body) - len(body.rstrip("\\"))) % 2 == 1


def split_features(spark: SparkSession, path: str) -> DataFrame:
    """``feature``: the JSON text of every object at the second level of the files below ``path``, each file one object.

    Files are read as pieces that end with a closing brace, so Spark splits them by size. Whether a split begins inside a string, and how
    deep, follows from the quotes and braces of the splits before: a first pass counts them for both cases, running sums give
    each split its beginning, and a second pass cuts the objects out. An object that lies across splits is put together from its parts.
    """
    pieces = spark.read.option("recursiveFileLookup", True).option("lineSep", "}").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, str]]:
        """Text of consecutive pieces of one split, a batch at a time."""
        for batch in batches:
            keys = list(zip(*[c.to_pylist() for c in batch.columns[1:]], strict=True))
            values, lo = batch.column(0).to_pylist(), 0
            for hi in range(1, len(keys) + 1):
                if hi == len(keys) or keys[hi] != keys[lo]:
                    yield keys[lo], "}".join([*values[lo:hi], ""])
                    lo = hi

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple, list[int]] = {}
        for key, text in stretches(batches):
            own = found.setdefault(key, [0, 0, 0])
            parts = re.sub(r"\\.", "", text, flags=re.S).split('"')
            for odd in (0, 1):  # a part is outside if the quotes before it are even, or else odd
                outside = "".join(parts[(own[0] + odd) % 2::2])
                own[1 + odd] += outside.count("{") - outside.count("}")
            own[0] += len(parts) - 1
        rows = [(*key, *own) for key, own in found.items()]
        names = ["file", "start", "quotes", "outside", "inside"]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string() if k == 0 else pa.int64()) for k in range(5)], names=names)

    counted = pieces.mapInArrow(count, "file string, start long, quotes long, outside long, inside long").groupBy("file", "start").agg(
        *[F.sum(c).alias(c) for c in ("quotes", "outside", "inside")])  # one row a split
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = counted.withColumn("in_string", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    begun = begun.withColumn("depth", F.coalesce(F.sum(F.when(F.col("in_string"), F.col("inside")).otherwise(F.col("outside"))).over(before), F.lit(0)))
    begun = cut_lineage(begun.select(F.col("file").alias("of"), F.col("start").alias("at"), "in_string", "depth"))
    placed = pieces.join(F.broadcast(begun), (F.col("file") == F.col("of")) & (F.col("start") == F.col("at"))).select("value", "file", "start", "in_string", "depth")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, objects = None, None

        def made(rows: list[tuple[int, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key[0]] * len(rows), pa.string()), pa.array([key[1]] * len(rows), pa.int64()),
                                               pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string())], names=["file", "start", "part", "text"])

        for own, text in stretches(batches):
            if own != key:
                if objects:
                    yield made(list(objects.rest()))
                key, objects = own, _Objects(own[2], own[3])
            yield made(list(objects.feed(text)))
        if objects:
            yield made(list(objects.rest()))

    cut_out = cut_lineage(placed.mapInArrow(cut, "file string, start long, part int, text string"))
    order = Window.partitionBy("file").orderBy("start", F.col("part") == _HEAD).rowsBetween(Window.unboundedPreceding, 0)
    head = F.last(F.when(F.col("part") == _HEAD, F.col("start")), ignorenulls=True).over(order)
    torn = cut_out.where(F.col("part") != _WHOLE).withColumn("head", head).groupBy("file", "head").agg(  # two rows a split at most
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), "").alias("feature"))
    return cut_out.where(F.col("part") == _WHOLE).select(F.col("text").alias("feature")).unionByName(torn.select("feature"))


def with_shapes(features: DataFrame) -> DataFrame:
    """Adds ``parts`` (areas) and ``point`` (points) parsed from the geometry."""
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    return features.withColumns({"parts": parse_parts(kind, text), "point": parse_point(kind, text)})


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_sheets(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """All sheets of a workbook kept as folders ``sheet=<name>`` of delimited files; ``sheet`` is a column."""
    return spark.read.schema(schema).option("sep", sep).option("header", True).csv(path)


def write_extract(df: DataFrame, path: str, style: str = "csv", sep: str = ",") -> str:
    """Prepared table for other tools."""
    writer = df.write.mode("errorifexists")
    if style == "csv":
        writer.option("header", True).option("sep", sep).csv(path)
    elif style == "json":
        writer.json(path)
    else:
        raise ValueError(f"style {style!r}")
    return path
