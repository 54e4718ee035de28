"""Scans and sinks. Paths are Spark paths; nothing opens files by itself."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.sources.markup import CSV_OPTIONS, csv_records


class MissingColumns(ValueError):
    """A scan lacks required columns."""


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    lacking = sorted(set(columns) - set(df.columns))
    if lacking:
        raise MissingColumns(", ".join(lacking))
    return df


def read_tables(spark: SparkSession, paths: dict[str, list[str]]) -> DataFrame:
    """Mixed ``csv``, ``json`` and ``parquet`` inputs united by column name, with the file each row came from."""
    frames = []
    for kind, where in sorted(paths.items()):
        if where:
            reader = spark.read.option("recursiveFileLookup", "true")
            reader = reader.option("header", "true") if kind == "csv" else reader
            frames.append(reader.format(kind).load(where).withColumn("source_input_file", F.col("_metadata.file_path")))
    if not frames:
        raise FileNotFoundError("no input files")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def coalesce_alias(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Canonical columns filled from their aliases where they are absent, null or blank; source columns stay."""
    by_lower = {c.lower(): c for c in df.columns}
    for name, others in aliases.items():
        have = [by_lower[a.lower()] for a in [name, *others] if a.lower() in by_lower]
        if have:
            df = df.withColumn(name, F.coalesce(*[F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in have]))
    return df


def csv_after_preamble(spark: SparkSession, path: str, header: str, schema: str) -> DataFrame:
    """CSV files whose header row comes after other lines: the rows after the first line that starts with ``header``, under ``schema``.

    The header's names must be those of the schema in its order. A file without the header, or with other names, fails the query when it runs. Blank lines are skipped, quoted fields may hold line ends. A file
    is one report and is read whole.
    """
    lines = F.split(F.regexp_replace("value", "^\ufeff", ""), r"\r\n|\r|\n")
    read = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), lines.alias("lines"))
    place = F.array_position(F.transform("lines", lambda s: F.startswith(s, F.lit(header))), True)
    names = ",".join(f.strip().split()[0] for f in schema.split(","))
    first = F.element_at("lines", F.col("at").cast("int"))
    told = F.when(F.col("at") == 0, F.raise_error(F.concat(F.lit("no header in "), "file"))).when(first != names, F.raise_error(F.concat(F.lit("other columns in "), "file"))).otherwise(
        csv_records(F.array_join(F.slice("lines", F.col("at").cast("int") + 1, F.size("lines")), "\n"))
    )
    body = read.withColumn("at", place).select(F.explode(told).alias("line"))
    return body.select(F.from_csv("line", schema, CSV_OPTIONS).alias("r")).select("r.*")


def zipped_lines(spark: SparkSession, path: str, member: str, encoding: str = "utf-8") -> DataFrame:
    """(file, line) of the text member of each ZIP archive; archives are opened one by one in the tasks, members are streamed and never held whole."""
    import io
    import zipfile

    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_buffer().to_pybytes())) as archive, archive.open(member) as raw:
                    held: list[str] = []
                    for line in io.TextIOWrapper(raw, encoding=encoding, newline="\n"):
                        held.append(line.rstrip("\r\n"))
                        if len(held) == 10_000:
                            yield pa.RecordBatch.from_pydict({"file": [file] * len(held), "line": held})
                            held = []
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(held), pa.string()), pa.array(held, pa.string())], ["file", "line"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, line string")


def zipped_members(spark: SparkSession, path: str, suffix: str = ".json", encoding: str = "utf-8") -> DataFrame:
    """(file, member, text) of every member of each ZIP archive whose name ends with ``suffix``, in the order of names; parse with ``from_json``."""
    import io
    import zipfile

    import pyarrow as pa

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_buffer().to_pybytes())) as archive:
                    for name in sorted(n for n in archive.namelist() if n.endswith(suffix)):
                        yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([name]), pa.array([archive.read(name).decode(encoding)])], ["file", "member", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "file string, member string, text string")


def city_index(lines: DataFrame, key, needed: DataFrame | None = None) -> DataFrame:
    """Lines of a gazetteer in tab-separated columns -> one row per alias key and place: key, name, lat, lon, country_code, admin1, population, geonames_id.

    Lines of fewer than 19 columns are left out. Aliases are the name, the ASCII name and the listed other names, compared by the Column function ``key``; ``needed`` (key) limits them.
    """
    f = lambda i: F.get("f", F.lit(i))
    rows = lines.select(F.split("line", "\t", -1).alias("f")).where(F.size("f") >= 19)
    names = F.array_distinct(F.concat(F.array(f(1), f(2)), F.filter(F.split(f(3), ","), lambda x: x != "")))
    flat = rows.select(
        F.explode(names).alias("alias"), f(1).alias("name"), f(4).try_cast("double").alias("lat"), f(5).try_cast("double").alias("lon"), f(8).alias("country_code"),
        f(10).alias("admin1"), F.coalesce(f(14).try_cast("long"), F.lit(0).cast("long")).alias("population"), f(0).alias("geonames_id"),
    )
    keyed = flat.withColumn("key", key(F.col("alias"))).drop("alias").distinct()
    return keyed if needed is None else keyed.join(needed.select("key").distinct(), "key", "left_semi")


def register(rows: DataFrame, identifier: str, order: str) -> DataFrame:
    """A dimension by trimmed identifier, all texts trimmed; of rows that repeat one the last by ``order``. Blank identifiers are left out."""
    texts = [c for c, t in rows.dtypes if t == "string"]
    clean = rows.select(*[F.coalesce(F.trim(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in rows.columns]).where(F.col(identifier) != "")
    last = clean.groupBy(identifier).agg(F.max(F.struct(order, *[c for c in rows.columns if c not in (identifier, order)])).alias("r"))
    return last.select(identifier, "r.*").select(*rows.columns)


class UnknownBoundaries(ValueError):
    """No code or name column among a boundary table's columns."""


def boundary_columns(columns: list[str], level: str) -> dict[str, str]:
    """Source column -> canonical column of a boundary table of ``adm1`` or ``adm2``, the first alias that is there."""
    level, digit = level.lower(), level[-1]
    aliases = {
        f"{level}_code": (f"{level}_code", "shapeID", "shape_id", f"GID_{digit}"), f"{level}_name": (f"{level}_name", "shapeName", "shape_name", f"NAME_{digit}"),
        "adm0_code": ("adm0_code", "shapeGroup", "shape_group", "GID_0"),
    }
    found = {name: next((a for a in others if a in columns), None) for name, others in aliases.items()}
    if lacking := [n for n, source in found.items() if source is None and n != "adm0_code"]:
        raise UnknownBoundaries(f"no {', '.join(lacking)} among {', '.join(columns)}")
    return {source: name for name, source in found.items() if source}


def read_boundaries(spark: SparkSession, path: str, level: str, properties: list[str]) -> DataFrame:
    """A GeoJSON feature collection in degrees -> code, name, adm0_code, rings (all rings of all parts, for even-odd tests); codes that are null or repeat fail the query when it runs."""
    selected = boundary_columns(properties, level)
    feature = f"struct<properties: struct<{', '.join(f'{p}: string' for p in properties)}>, geometry: struct<type: string, coordinates: string>>"
    doc = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"struct<features: array<{feature}>>")["features"]).alias("f"))
    deep = F.from_json("f.geometry.coordinates", "array<array<array<array<double>>>>")
    flat = F.from_json("f.geometry.coordinates", "array<array<array<double>>>")
    rings = F.when(F.col("f.geometry.type") == "MultiPolygon", F.flatten(deep)).otherwise(flat)
    corner = lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat"))
    named = {name: F.col(f"f.properties.{source}") for source, name in selected.items()}
    code = f"{level.lower()}_code"
    rows = doc.select(
        named[code].alias("code"), named[f"{level.lower()}_name"].alias("name"), named.get("adm0_code", F.lit(None).cast("string")).alias("adm0_code"),
        F.transform(rings, lambda r: F.transform(r, corner)).alias("rings"),
    )
    copies = rows.groupBy("code").agg(F.count("*").alias("_n"))
    bad = F.col("code").isNull() | (F.col("_n") > 1)
    failed = F.raise_error(F.concat(F.lit("boundary codes must be unique and not null: "), F.coalesce("code", F.lit("null")))).cast("boolean")
    joined = rows.join(copies.withColumnRenamed("code", "_code"), F.col("code").eqNullSafe(F.col("_code")))
    return joined.where(F.when(bad, failed).otherwise(True)).select("code", "name", "adm0_code", "rings")


def markdown_rows(text: Column) -> Column:
    """Pipe-table rows of a document -> array<array<string>>, rules and other lines left out."""
    lines = F.filter(F.split(text, "\n"), lambda s: F.startswith(F.trim(s), F.lit("|")) & ~F.trim(s).rlike(r"^\|[\s:|\-]+\|?$"))
    return F.transform(lines, lambda s: F.transform(F.split(F.btrim(F.trim(s), F.lit("|")), r"\|"), lambda c: F.trim(c)))


def html_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)


def write_missing_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Writes the partitions that are not there yet; those that are stay as they are. A partition is put in place whole, so of two writers at once the later one's stands and no row stands twice."""
    spark = df.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        there = spark.read.schema(df.schema).option("basePath", path).parquet(path).select(*[F.col(c).cast("string").alias(f"_{c}") for c in by]).distinct()
        df = df.join(there, reduce(Column.__and__, [F.col(c).cast("string").eqNullSafe(F.col(f"_{c}")) for c in by]), "left_anti")
    write_partitions(df, path, by)


def write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces only the partitions that ``df`` holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_both(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    df.write.mode("overwrite").option("header", "true").csv(f"{path}/csv")


def rename_over(spark: SparkSession, source: str, target: str) -> None:
    """Puts a finished file in the place of another in one step."""
    jvm = spark._jvm
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in (source, target)]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(paths[1].getFileSystem(spark._jsc.hadoopConfiguration()).getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(*[context.makeQualified(p) for p in paths], options)


def envelope(records: DataFrame, summary: DataFrame, unresolved: DataFrame, path: str) -> str:
    """Dashboard document as JSON lines by part, so no task gathers all records. Returns the folder of this version.

    The parts are written to a folder of their own; then a finished pointer file is renamed over ``path/current``, so a reader sees all three parts of one version or of the one before.
    """
    spark, version = records.sparkSession, f"{path}/version-{uuid.uuid4().hex}"
    for name, df in (("records", records), ("summary", summary), ("unresolved", unresolved)):
        df.select(F.to_json(F.struct("*")).alias("value")).write.text(f"{version}/{name}")
    pointer = spark._jvm.org.apache.hadoop.fs.Path(f"{version}/pointer")
    out = pointer.getFileSystem(spark._jsc.hadoopConfiguration()).create(pointer)
    out.writeBytes(version)
    out.close()
    rename_over(spark, f"{version}/pointer", f"{path}/current")
    return version


def read_envelope(spark: SparkSession, path: str, part: str, schema: str) -> DataFrame:
    """A part of the current version of an ``envelope``."""
    version = spark.read.text(f"{path}/current").first().value
    return spark.read.schema(schema).json(f"{version}/{part}")


def queue_sinks(queues: dict[str, DataFrame], path: str) -> None:
    """Review queues as CSV with a header each, empty ones too; written whether validation passes or not."""
    for name, df in sorted(queues.items()):
        df.write.mode("overwrite").option("header", "true").csv(f"{path}/{name}")


def features(cells: DataFrame, ring: str, properties: list[str]) -> DataFrame:
    """GeoJSON features, one JSON text a row; a ring that does not end where it starts is closed."""
    first, last = F.get(ring, F.lit(0)), F.element_at(ring, -1)
    closed = F.when(first == last, F.col(ring)).otherwise(F.array_append(ring, first))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(closed, lambda p: F.array(p["lon"], p["lat"]))).alias("coordinates"))
    return cells.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*properties).alias("properties"))).alias("value"))


def feature_collection(cells: DataFrame, ring: str, properties: list[str], metadata: dict[str, str]) -> DataFrame:
    """One GeoJSON FeatureCollection with its metadata as a single row, features in the order of their texts; for a file that a browser reads whole."""
    made = features(cells, ring, properties)
    head = ", ".join(f"{json.dumps(k)}: {json.dumps(v)}" for k, v in sorted(metadata.items()))
    listed = F.array_join(F.array_sort(F.collect_list("value")), ", ")
    return made.agg(F.concat(F.lit('{"type": "FeatureCollection", "metadata": {' + head + '}, "features": ['), listed, F.lit("]}")).alias("value"))


def guard_target(path: str, protected: dict[str, str], cohort: str) -> str:
    """Refuses to write one cohort to another's published path."""
    if protected.get(path, cohort) != cohort:
        raise PermissionError(f"{path} belongs to {protected[path]}")
    return path
