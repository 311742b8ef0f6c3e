"""Sources and sinks."""

from __future__ import annotations

import csv
import io
import uuid
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillbank.functions.textnorm import collapsed
from quillbank.sources.schemas import SCHEMAS

#: What a Windows file means by the control characters that Latin-1 sees in it; the five bytes without a meaning stay.
_WINDOWS = {b: bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
_SEEN, _MEANT = "".join(chr(b) for b, c in _WINDOWS.items() if c), "".join(_WINDOWS.values())
_UNDEFINED = [chr(b) for b, c in _WINDOWS.items() if not c]


def read_tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    """Whole tables by name; a known table is read with its fixed schema."""
    return [(spark.read.schema(SCHEMAS[n]) if n in SCHEMAS else spark.read).parquet(f"{folder}/{n}.parquet") for n in names]


def decoded(content: Column) -> tuple[Column, Column]:
    """Text and encoding of a file's bytes: UTF-8 if they are valid in it (a byte order mark goes), else Windows-1252 if all its bytes mean something there, else Latin-1."""
    plain = content.cast("string")
    latin = F.decode(content, "iso-8859-1")
    windows = F.translate(latin, "".join(_UNDEFINED), "") == latin
    encoding = F.when(F.is_valid_utf8(plain), "utf-8").when(windows, "cp1252").otherwise("latin-1")
    text = F.when(encoding == "utf-8", F.regexp_replace(F.make_valid_utf8(plain), "^\ufeff", "")).when(encoding == "cp1252", F.translate(latin, _SEEN, _MEANT)).otherwise(latin)
    return text, encoding


def read_syllabus_csv(spark: SparkSession, path: str) -> DataFrame:
    """Syllabus rows of every file of a path: the columns, and ``path, line, encoding``.

    Each file is decoded by its own encoding and read by its own header: columns are found by name, unknown ones are
    ignored, missing ones and missing values are empty. White space is collapsed, codes are in upper case and the topic is a
    number (null if it is none). Fields may be quoted and hold line ends. A file is one row for its task, so files are
    expected to be small (a syllabus); any number of them are read in one job.
    """
    names = spark.createDataFrame([], SCHEMAS["syllabus_csv"]).columns
    text, encoding = decoded(F.col("content"))
    files = spark.read.format("binaryFile").load(path).select("path", encoding.alias("encoding"), text.alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for file, code, whole in f.itertuples(index=False):
                rows = csv.DictReader(io.StringIO(whole, newline=""))
                yield pd.DataFrame([[file, code, k, *[r.get(n) or "" for n in names]] for k, r in enumerate(rows, 1)], columns=["path", "encoding", "line", *names])

    schema = f"path string, encoding string, line long, {', '.join(f'{n} string' for n in names)}"
    rows = files.mapInPandas(run, schema).withColumns({n: collapsed(F.col(n)) for n in names})
    return rows.withColumn("parte", F.upper("parte")).withColumn("tipo", F.upper("tipo")).withColumn("tema", F.col("tema").try_cast("int"))


def validate_syllabus(rows: DataFrame) -> DataFrame:
    """Violations by rule: ``rule, parte, tema``."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    rules = {
        "PART": empty("parte"), "TITLE": empty("titulo"), "TOPIC": F.coalesce(F.col("tema"), F.lit(0)) <= 0, "TYPE": ~F.coalesce(F.col("tipo").isin("JURIDICO", "INFORMATICA", "OTROS"), F.lit(False)),
        "ARTICLE_WITHOUT_NORM": ~empty("articulo") & empty("LEY"),
    }
    failed = F.filter(F.array(*[F.when(bad, F.lit(n)) for n, bad in rules.items()]), lambda f: f.isNotNull())
    by_row = rows.select(F.explode(failed).alias("rule"), "parte", "tema")
    titles = rows.groupBy("parte", "tema").agg(F.count_distinct("titulo").alias("n")).filter("n > 1").select(F.lit("TITLES").alias("rule"), "parte", "tema")
    return by_row.unionByName(titles)


def read_call_config(spark: SparkSession, path: str) -> DataFrame:
    """One row per part of each call's configuration."""
    calls = spark.read.schema(SCHEMAS["call_config"]).json(path, multiLine=True)
    return calls.select("codigo", "posicion", "activa", F.col("numero_preguntas").alias("total"), "puntuacion.*", F.inline_outer("partes"))


def read_matches_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS["matches_json"]).json(path, multiLine=True)


def read_page_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def write_report(frames: list[DataFrame], path: str, sep: str = ",") -> None:
    """Reports as CSV with a header; columns are the union of the frames'."""
    reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).write.mode("overwrite").csv(path, header=True, sep=sep)


def write_summary(metrics: DataFrame, path: str) -> None:
    """One JSON object from rows of ``name, value``."""
    whole = metrics.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias("metrics"))
    whole.write.mode("overwrite").json(path)


def publish_jdbc(df: DataFrame, url: str, table: str, flags: tuple[str, ...] = (), batch: int = 5_000) -> None:
    """Truncate and reload a table, 0/1 flags as booleans; raise if it doesn't hold as many rows as ``df`` afterwards.

    Tables that refer to others are published after them.
    """
    out = df.withColumns({c: F.col(c).cast("boolean") for c in flags})
    out.write.option("truncate", True).option("batchsize", batch).jdbc(url, table, mode="overwrite")
    want, got = df.count(), df.sparkSession.read.jdbc(url, table).count()
    if want != got:
        raise ValueError(f"{table} holds {got} rows instead of {want}")


def load_order(references: dict[str, set[str]]) -> list[str]:
    """Tables so that each comes after those it refers to (itself apart), by name where free; ``ValueError`` names a cycle."""
    left = {t: {r for r in refs if r != t} for t, refs in references.items()}
    if unknown := sorted({r for refs in left.values() for r in refs} - set(left)):
        raise ValueError(f"references to tables that aren't published: {', '.join(unknown)}")
    order: list[str] = []
    while left:
        free = sorted(t for t, refs in left.items() if refs <= set(order))
        if not free:
            at, seen = min(left), []
            while at not in seen:
                seen.append(at)
                at = min(left[at] - set(order))
            raise ValueError(f"cycle of references: {' -> '.join([*seen[seen.index(at):], at])}")
        order += free
        left = {t: refs for t, refs in left.items() if t not in free}
    return order


def publish_all(tables: dict[str, DataFrame], references: dict[str, dict[str, tuple[str, str]]], url: str, flags: dict[str, tuple[str, ...]] | None = None, batch: int = 5_000) -> dict[str, int]:
    """Replace the tables of a database by new ones, all at one moment; return their numbers of rows.

    ``references``: table to its columns to (table, column) that they refer to; null refers to nothing. Executors write
    staged copies; these are read back, and their counts and references are checked there. Only then one transaction
    empties the tables, those that refer to others first, fills them from the copies inside of the database in the opposite
    order, and counts them again. Readers see all old rows until it commits; if anything fails it is rolled back and they stay.
    Tables that don't exist are created as their copies.
    """
    spark = next(iter(tables.values())).sparkSession
    order = load_order({t: {r[0] for r in references.get(t, {}).values()} for t in tables})
    staged, want = {}, {}
    for t in order:
        out = tables[t].withColumns({c: F.col(c).cast("boolean") for c in (flags or {}).get(t, ())})
        out.write.option("batchsize", batch).jdbc(url, f"stage_{t}", mode="overwrite")
        staged[t], want[t] = spark.read.jdbc(url, f"stage_{t}"), out.count()
    wrong = [f"{t} holds {n} rows instead of {want[t]}" for t in order if (n := staged[t].count()) != want[t]]
    for t in order:
        for column, (other, key) in references.get(t, {}).items():
            lost = staged[t].filter(F.col(column).isNotNull()).join(staged[other].select(F.col(key).alias(column)), column, "left_anti").count()
            wrong += [f"{lost} rows of {t} refer by {column} to nothing in {other}"] if lost else []
    if wrong:
        raise ValueError("; ".join(wrong))

    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        statement, found = connection.createStatement(), connection.getMetaData()
        quoted = lambda names: ", ".join(f'"{c}"' for c in names)

        def exists(t: str) -> bool:
            return any(found.getTables(None, None, name, None).next() for name in (t, t.upper()))

        for t in order:
            if not exists(t):
                statement.executeUpdate(f"CREATE TABLE {t} AS SELECT * FROM stage_{t} WITH NO DATA")
        for t in reversed(order):
            statement.executeUpdate(f"DELETE FROM {t}")
        for t in order:
            columns = quoted(staged[t].columns)
            if (n := statement.executeUpdate(f"INSERT INTO {t} ({columns}) SELECT {columns} FROM stage_{t}")) != want[t]:
                raise ValueError(f"{t} took {n} rows instead of {want[t]}")
        connection.commit()
    except BaseException:
        connection.rollback()
        raise
    finally:
        connection.close()
    return want


def overwrite_table(df: DataFrame, folder: str, checks: dict[str, DataFrame]) -> str:
    """Write a new version beside the old ones and return its path if no check has rows; else raise and leave the old version as it is.

    The caller stores the returned path as the table's current version, which is the only step that readers see.
    """
    path = f"{folder}/v-{uuid.uuid4().hex}"
    df.write.parquet(path)
    failed = [n for n, bad in checks.items() if not bad.isEmpty()]
    if failed:
        raise ValueError(f"checks failed: {', '.join(failed)}; {path} isn't published")
    return path
