"""Batch files. Schemas are declared, so no read infers types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.strings import details_of, full_address, street_of


_BROKEN = "_broken"
PACKED_ROWS = 1_000_000  # rows of a packed part of a table


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """The names in the first line of a CSV file, or of one file of a folder."""
    first = spark.read.option("header", False).csv(path).first()
    if first is None:
        raise ValueError(f"no header in {path}")
    return ["" if name is None else name for name in first]


def _by_header(spark: SparkSession, path: str, schema: T.StructType):
    """A reader, all columns of the header, and the names there of the declared columns.

    Other columns are texts. Where all names of the header are different, Spark compares the
    header of each file with it; repeated or empty names cannot be compared.
    """
    names = csv_header(spark, path)
    plain = [name.strip() for name in names]
    for field in schema.fields:
        if plain.count(field.name) != 1:
            problem = "missing" if field.name not in plain else "repeated"
            raise ValueError(f"{problem} column {field.name!r} in the header of {path}")
    comparable = all(plain) and len({name.lower() for name in names}) == len(names)
    own = names if comparable else [n if n in schema.names else f"_column {i}" for i, n in enumerate(plain)]
    types = {f.name: f.dataType for f in schema.fields}
    full = T.StructType([T.StructField(n, types.get(p, T.StringType())) for n, p in zip(own, plain)])
    where = {p: n for n, p in zip(own, plain) if p in types}
    reader = spark.read.options(header=True, enforceSchema=not comparable)
    return reader, full, [where[f.name] for f in schema.fields]


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header: one file, or a folder of part files read as one table.

    The header is read once; the columns of the schema are picked by name, wherever they
    stand, and only they are parsed. A declared column that the header lacks or repeats is
    an error, and so is a file of the folder with another header. Unreadable values are
    null; :func:`read_csv_checked` sets such lines aside.
    """
    reader, full, names = _by_header(spark, path, schema)
    columns = [F.col(f"`{own}`").alias(f.name) for own, f in zip(names, schema.fields)]
    return reader.schema(full).csv(path).select(*columns)


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV whose lines are whole, and ``line, reason`` of all others.

    Broken are lines with another number of fields than the header has, and lines with a
    value in a declared column that is not of its type. Declared columns are picked by name,
    as in :func:`read_csv`; lines that repeat the header and blank ones are left out. Values
    do not span lines. Each of the two tables parses the file once when it is used.
    """
    _, full, names = _by_header(spark, path, schema)
    lines = spark.read.text(path).withColumnRenamed("value", "line").filter(F.trim("line") != "")
    header = spark.read.text(path).filter(F.trim("value") != "").first()
    if header is not None:
        lines = lines.filter(F.col("line") != header.value)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}

    def parsed(rows: DataFrame, typed: bool) -> DataFrame:
        types = [f.dataType.simpleString() if typed else "string" for f in full.fields]
        fields = ", ".join(f"c{i} {t}" for i, t in enumerate(types))
        # by a generator, so no filter on the fields can repeat the parsing below it
        return rows.select("*", F.inline(F.array(F.from_csv("line", f"{fields}, {_BROKEN} string", options))))

    place = {f.name: i for i, f in enumerate(full.fields)}
    picked = [F.col(f"c{place[own]}").alias(f.name) for own, f in zip(names, schema.fields)]
    rows = parsed(lines, True)
    good = rows.filter(F.col(_BROKEN).isNull()).select(*picked)
    typed = F.struct(*[F.col(f"c{place[own]}") for own in names]).alias("_typed")
    broken = parsed(rows.filter(F.col(_BROKEN).isNotNull()).select("line", typed), False)
    unreadable = [
        F.when(F.col(f"c{place[own]}").isNotNull() & F.col(f"_typed.c{place[own]}").isNull(), F.lit(f.name))
        for own, f in zip(names, schema.fields)
    ]
    reason = F.when(F.col(_BROKEN).isNotNull(), F.lit("number of fields")).otherwise(
        F.concat(F.lit("value of "), F.concat_ws(", ", *unreadable))
    )
    return good, broken.select("line", reason.alias("reason"))


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON document per line."""
    return spark.read.schema(schema).json(path)


def read_address_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``street # details`` lines as (street, details, address), and the unusable lines."""
    lines = spark.read.text(path).withColumnRenamed("value", "line")
    marked = F.col("line").contains("#")
    good = lines.filter(marked).select(
        street_of(F.col("line")).alias("street"),
        details_of(F.col("line")).alias("details"),
        full_address(F.col("line")).alias("address"),
    )
    return good, lines.filter(~marked).withColumn("reason", F.lit("no # in line"))


def read_scored(spark: SparkSession, path: str) -> DataFrame:
    """The scored points, partitioned by event date."""
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, packed: bool = False) -> None:
    """CSV with a header, overwritten. Every task writes its own part of the folder.

    ``packed`` parts are gzip files, which the readers here unpack by their name. One of them is
    read by one task, so a part ends after ``PACKED_ROWS`` rows.
    """
    writer = df.write.mode("overwrite").option("header", True)
    if packed:
        writer = writer.options(compression="gzip", maxRecordsPerFile=PACKED_ROWS)
    writer.csv(path)


def check_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the contract in its order; a missing column or another type fails."""
    have = {f.name: f.dataType for f in df.schema.fields}
    for field in schema.fields:
        if field.name not in have:
            raise ValueError(f"missing column {field.name!r}")
        if have[field.name].simpleString() != field.dataType.simpleString():
            raise ValueError(
                f"column {field.name!r} is {have[field.name].simpleString()}, "
                f"not {field.dataType.simpleString()}"
            )
    return df.select(*[F.col(f"`{f.name}`") for f in schema.fields])


def check_table(found: T.StructType, schema: T.StructType, name: str) -> None:
    """Fail unless a table has every column of the schema with its type; it may have more."""
    have = {f.name: f.dataType.simpleString() for f in found.fields}
    for field in schema.fields:
        want = field.dataType.simpleString()
        if have.get(field.name) != want:
            is_ = f"is {have[field.name]}" if field.name in have else "is missing"
            raise ValueError(f"column {field.name!r} of table {name} {is_}, not {want}")


def ensure_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str, partition_by: Sequence[str] = ()
) -> bool:
    """Create the typed table unless it exists; tells whether it was created.

    ``partition_by`` are columns of the schema. A table that exists must have the schema's
    columns with their types and the same partitions; columns added to it are fine.
    """
    if spark.catalog.tableExists(name):
        check_table(spark.table(name).schema, schema, name)
        parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        if parts != list(partition_by):
            raise ValueError(f"table {name} is partitioned by {parts}, not {list(partition_by)}")
        return False
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parts = f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {parts} LOCATION '{location}'")
    return True


def append_table(df: DataFrame, name: str) -> None:
    """Append rows that meet the table's contract."""
    check_contract(df, df.sparkSession.table(name).schema).write.insertInto(name)


def replace_partitions(df: DataFrame, name: str) -> None:
    """Write rows to a partitioned table; the partitions they fall into are replaced.

    Columns go by name; those that were added to the table and are not in ``df`` are null.
    """
    spark = df.sparkSession
    schema = spark.table(name).schema
    rows = df.select(
        *[F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        check_contract(rows, schema).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(setting, before)
