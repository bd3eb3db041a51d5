"""Readers for the dump shapes open data sources ship (SRC-1..9).

Each reader returns a lazy DataFrame.  The only eager steps read a header line
(one row) or list file names; no data row passes through the driver.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from releasekit.functions.columns import read_as


def string_schema(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def spread(df: DataFrame, n: int | None) -> DataFrame:
    """gzip text is not splittable: one task per file.  For a few large files, spread the
    rows over ``n`` partitions straight after the read so downstream stages (and AQE skew
    splitting, which works along map outputs) have many tasks.  Round-robin: no key skew."""
    return df.repartition(n) if n else df


def _files(spark: SparkSession):
    """A dump directory is a bag of files (possibly nested): no partition inference."""
    return spark.read.option("recursiveFileLookup", "true")


def _first_line(spark: SparkSession, path: str, predicate) -> str:
    row = _files(spark).text(path).where(predicate).limit(1).first()
    if row is None:
        raise ValueError(f"no header line found under {path}")
    return row["value"]


# --- SRC-1: preamble before the header -------------------------------------------------

#: What the CSV parser puts for an empty field; no text holds it, so "" stays apart from null.
NO_TEXT = "\x00"
#: The tokens that the usual dataframe reader takes as null.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_preamble_tsv(
    spark: SparkSession,
    path: str,
    skip: int = 15,
    schema: T.StructType | None = None,
    sep: str = "\t",
    header_mark: str = "#",
    spread_to: int | None = None,
) -> DataFrame:
    """Delimited dump with ``skip`` preamble lines and then a header line in every file.

    Lines are dropped by count, so a data row may begin with any character.  Without
    ``schema`` the names come from the header of one file (a leading ``header_mark`` is
    dropped) and every column is a string; ``infer_types`` finds the types."""
    if schema is None:
        one = _files(spark).format("binaryFile").option("pathGlobFilter", "*").load(path).select("path").orderBy("path").first()
        if one is None:
            raise ValueError(f"no files under {path}")
        head = spark.read.text(one["path"]).head(skip + 1)
        if len(head) <= skip:
            raise ValueError(f"{one['path']} has no header line after {skip} lines")
        schema = string_schema(head[skip]["value"].removeprefix(header_mark).split(sep))
    return spread(read_skip_lines(spark, path, skip + 1, schema, sep), spread_to)


def read_commented_tsv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = "\t",
    header_mark: str = "#",
    preamble_mark: str = "##",
    spread_to: int | None = None,
) -> DataFrame:
    """The same for dumps whose data rows never begin with ``header_mark``: preamble and header
    are comment lines to the CSV reader, so splittable inputs stay split.  Fails if a file
    has more such lines than its one header, which would be data rows lost as comments."""
    marked = F.col("value").startswith(header_mark) & ~F.col("value").startswith(preamble_mark)
    if schema is None:
        schema = string_schema(_first_line(spark, path, marked)[len(header_mark):].split(sep))
    lost = _files(spark).text(path).where(marked).groupBy(F.col("_metadata.file_path").alias("file")).count().where("count > 1").first()
    if lost:
        raise ValueError(f"{lost['file']}: {lost['count']} lines begin with {header_mark!r}; read it by count (read_preamble_tsv)")
    return spread(_files(spark).schema(schema).csv(path, sep=sep, comment=header_mark[0], header=False,
                                                   mode="PERMISSIVE"), spread_to)


#: The types that text may have, as bits, from the narrowest; a value has all that give it back
#: unchanged as a value.
LATTICE = {"bigint": 1, "boolean": 2, "double": 4, "decimal": 8, "date": 16, "timestamp_ntz": 32}
_WHOLE, _PLAIN, _EXPONENT = r"^(0|-?[1-9][0-9]*)$", r"^-?(0|[1-9][0-9]*)\.[0-9]+$", r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?[eE][+-]?[0-9]{1,3}$"
_DAY, _TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"
_TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")
#: Significant digits that a double always gives back, and digits of a decimal.
DOUBLE_DIGITS, DECIMAL_DIGITS = 15, 38


def _type_bits(v: Column) -> Column:
    """The types of one value.  Numbers have no sign ``+``, no leading zeros and no spaces, else they
    are identifiers; a double has no more significant digits than it can give back."""
    whole, plain = v.rlike(_WHOLE), v.rlike(_PLAIN)
    significant = F.length(F.regexp_replace(F.regexp_replace(v, r"[eE].*$|[-.]", ""), r"^0+|0+$", ""))
    finite = F.abs(v.try_cast("double")) < F.lit(float("inf"))
    day = v.rlike(_DAY) & v.try_cast("date").isNotNull()
    bit = lambda test, name: F.when(test, LATTICE[name]).otherwise(0)
    found = [bit(whole & v.try_cast("bigint").isNotNull(), "bigint"), bit(v.isin(*_TRUTH), "boolean"),
             bit((whole | plain | v.rlike(_EXPONENT)) & (significant <= DOUBLE_DIGITS) & finite, "double"),
             bit((whole | plain) & ~v.rlike(r"^-0[.0]*$"), "decimal"), bit(day, "date"),
             bit(day | (v.rlike(_TIME) & v.try_cast("timestamp_ntz").isNotNull()), "timestamp_ntz")]
    return F.when(v.isNotNull(), reduce(lambda a, b: a.bitwiseOR(b), found))


def infer_types(df: DataFrame, na_tokens: tuple[str, ...] = NA_TOKENS) -> DataFrame:
    """String columns to the narrowest type of ``LATTICE`` that every value but the NA tokens has,
    the tokens to null; columns without such a type, or without values, stay text.

    Nothing is lost: ``1D``, ``2F``, ``007`` and ``+5`` are no numbers, whole numbers beyond 64
    bits and fractions beyond 15 digits become decimals.  One aggregation pass over all rows
    decides: the types of a column are the bits that all its values share."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not text:
        return df
    value = {c: F.when(~F.col(f"`{c}`").isin(*na_tokens), F.col(f"`{c}`")) for c in text}
    digits = lambda v: F.length(F.regexp_replace(F.substring_index(v, ".", 1), "-", ""))
    scale = lambda v: F.when(v.contains("."), F.length(F.substring_index(v, ".", -1))).otherwise(0)
    found = df.agg(*[x for i, c in enumerate(text) for x in (
        F.bit_and(_type_bits(value[c])).alias(f"bits{i}"), F.max(digits(value[c])).alias(f"digits{i}"), F.max(scale(value[c])).alias(f"scale{i}"))]).first()

    def kind(i: int) -> str:
        bits, size, point = found[f"bits{i}"] or 0, found[f"digits{i}"], found[f"scale{i}"]
        for name, bit in LATTICE.items():
            if bits & bit and (name != "decimal" or size + point <= DECIMAL_DIGITS):
                return f"decimal({size + point},{point})" if name == "decimal" else name
        return "string"

    return df.select(*[value[f.name].cast(kind(text.index(f.name))).alias(f.name) if f.name in value else F.col(f"`{f.name}`") for f in df.schema.fields])


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, start, id``: text lines, where their split begins, and a number that rises by
    one from line to line of a split."""
    return _files(spark).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))


def _splits(lines: DataFrame) -> DataFrame:
    """Per split of a file: the number of its first line (``first``), how many lines it has (``n``)
    and how many lie before it in the file (``before``).  One row per split reaches the shuffle."""
    per = lines.groupBy("file", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return per.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def _line_number() -> Column:
    """1-based line number of a line joined with its split.  Both passes over the files must deal
    them out alike; if the number of cores changed in between, the ids don't fit and it fails."""
    offset = F.col("id") - F.col("first")
    moved = F.raise_error(F.lit("files were dealt out differently in two passes; set spark.sql.files.minPartitionNum")).cast("bigint")
    return F.when((offset >= 0) & (offset < F.col("n")), F.col("before") + offset + 1).otherwise(moved)


def _kept_lines(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The lines of every file but its first ``n``, with ``file``, ``start`` and ``id``.  What is
    broadcast has a row for each file (more where ``n`` lines are more than a split), like the
    listing that the driver holds anyway."""
    lines = _lines(spark, path)
    if not n:
        return lines
    heads = F.broadcast(_splits(lines).where(F.col("before") < n))
    joined = lines.join(heads, ["file", "start"], "left")
    return joined.where(F.col("first").isNull() | (_line_number() > n)).select("value", "file", "start", "id")


def read_skip_lines(
    spark: SparkSession, path: str, n: int, schema: T.StructType, sep: str = "\t"
) -> DataFrame:
    """General form of SRC-1: drop the first ``n`` lines of every file, parse the rest.

    Works for preambles without a comment marker, also where they are longer than a split of a
    file.  Line numbers come from the order of lines within splits; parsing is ``from_csv``."""
    kept = _kept_lines(spark, path, n)
    parsed = kept.select(F.from_csv("value", ddl(schema), {"sep": sep, "nullValue": NO_TEXT}).alias("r"))
    return parsed.select("r.*")


# --- quarantine of malformed rows -----------------------------------------------------------

RESCUED = "_rescued"


def _fault(value: Column, row: Column, schema: T.StructType, sep: str) -> Column:
    """Why a line is no row of ``schema``, null if it is one.  Doubled quotes go first, then quoted
    fields; what is left shows the number of fields, and a quote at the start of one is stray."""
    mark = re.escape(sep)
    bare = F.regexp_replace(F.replace(value, F.lit('""'), F.lit("")), f'(^|{mark})"[^"]*+"(?={mark}|$)', "$1")
    fields = F.size(F.split(bare, mark, -1))
    stray = bare.rlike(f'(^|{mark})"') | value.rlike(f'(^|{mark})""[^"{mark}]')
    n = len(schema.fields)
    typed = [F.when(cell.isNotNull() & read_as(cell, f.dataType).isNull(), f"no {f.dataType.simpleString()} in {f.name}")
             for f in schema.fields if not isinstance(f.dataType, T.StringType) for cell in (row[f.name],)]
    return F.coalesce(F.when(stray, "bad quotes"), F.when(fields < n, "too few fields"), F.when(fields > n, "too many fields"), *typed, F.lit(None).cast("string"))


def read_rescued(spark: SparkSession, path: str, schema: T.StructType, sep: str = "\t", skip: int = 0,
                 na_tokens: tuple[str, ...] = ("",)) -> DataFrame:
    """Delimited lines without silent nulls: a line with too few or too many fields, badly placed
    quotes or a value of another type has nulls in all columns of ``schema`` and ``_rescued``
    (``file, start, id, text, fault``), which is null for good rows.  ``skip`` leading lines of
    every file are dropped; cells equal to one of ``na_tokens`` are null.  Quotes within a quoted
    field are doubled."""
    kept = _kept_lines(spark, path, skip)
    row = F.from_csv("value", ddl(string_schema(schema.names)), {"sep": sep, "escape": "\"", "nullValue": NO_TEXT})
    parsed = kept.select("*", row.alias("__row"))
    cells = F.struct(*[F.when(~F.col("__row")[f.name].isin(*na_tokens), F.col("__row")[f.name]).alias(f.name) for f in schema.fields])
    parsed = parsed.withColumn("__row", cells)
    parsed = parsed.withColumn("__fault", _fault(F.col("value"), F.col("__row"), schema, sep))
    good = F.col("__fault").isNull()
    return parsed.select(*[F.when(good, read_as(F.col("__row")[f.name], f.dataType)).alias(f.name) for f in schema.fields],
                         F.when(~good, F.struct("file", "start", "id", F.col("value").alias("text"), F.col("__fault").alias("fault"))).alias(RESCUED))


def good_rows(df: DataFrame, count_into: Observation | None = None) -> DataFrame:
    """Rows without a fault.  With ``count_into``, whatever consumes the result also counts
    ``n_read`` and ``n_bad`` there."""
    if count_into is not None:
        df = df.observe(count_into, F.count(F.lit(1)).alias("n_read"), F.count(RESCUED).alias("n_bad"))
    return df.where(F.col(RESCUED).isNull()).drop(RESCUED)


def quarantined(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """``file, line, text, fault`` of the rows that ``read_rescued`` set aside; ``line`` is the
    number in the file.  Only these rows meet the table of splits."""
    bad = df.where(F.col(RESCUED).isNotNull()).select(f"{RESCUED}.*")
    return bad.join(_splits(_lines(spark, path)), ["file", "start"]).select("file", _line_number().alias("line"), "text", "fault")


# --- SRC-2 / SRC-5: plain delimited --------------------------------------------------------

def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = "\t",
    header: bool = True,
    schema: T.StructType | None = None,
    multi_line: bool = False,
    recursive: bool = False,
    spread_to: int | None = None,
) -> DataFrame:
    """Delimited text; without a schema every column stays a string (no inference pass).  An empty
    field is null, a quoted empty one the empty string."""
    r = spark.read.option("nullValue", NO_TEXT).option("sep", sep).option("header", header).option("multiLine", multi_line)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if schema is not None:
        r = r.schema(schema)
    return spread(r.csv(path), spread_to)


def read_chunks(spark: SparkSession, directory: str, schema: T.StructType, sep: str = ",",
                multi_line: bool = False, spread_to: int | None = None) -> DataFrame:
    """Directory of headerless numbered chunks read as one table (SRC-5)."""
    return read_delimited(spark, directory, sep=sep, header=False, schema=schema,
                          multi_line=multi_line, recursive=True, spread_to=spread_to)


# --- SRC-3: pipe file with '#' header and trailing delimiter -------------------------------

def read_trailing_delimited(spark: SparkSession, path: str, sep: str = "|", mark: str = "#") -> DataFrame:
    """Header like ``#A|B|``: strip the mark from the first name and drop the phantom
    column produced by the trailing delimiter (structural, no data pass)."""
    df = _files(spark).csv(path, sep=sep, header=True)
    names = list(df.columns)
    if names and names[0].startswith(mark):
        names[0] = names[0][len(mark):]
    df = df.toDF(*names)
    if names and re.fullmatch(r"_c\d+", names[-1]):
        df = df.drop(names[-1])
    return df


# --- SRC-4: headerless read with repaired names --------------------------------------------

def repaired_header(spark: SparkSession, path: str, marker: str = "#Format: ", token: str = "<tab>") -> list[str]:
    """Names from a malformed header line whose separators are literal ``token`` text."""
    line = _first_line(spark, path, F.col("value").startswith(marker))
    return [n.strip() for n in line[len(marker):].split(token)]


def read_with_repaired_header(
    spark: SparkSession, path: str, marker: str = "#Format: ", token: str = "<tab>", sep: str = "\t",
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """First line of each file is skipped; names come from the repaired header.  ``rename``
    fixes swapped headers (D12) after the read."""
    names = repaired_header(spark, path, marker, token)
    df = (_files(spark).schema(string_schema(names))
          .option("enforceSchema", "true").csv(path, sep=sep, header=True))
    if rename:
        df = df.toDF(*[rename.get(c, c) for c in df.columns])
    return df


# --- SRC-6: chunk completeness -------------------------------------------------------------

def chunk_numbers(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """Distinct chunk numbers found under ``directory`` (file listing only: content not read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
             .select("path"))
    no = F.regexp_extract("path", pattern, 1)
    return files.select(F.when(no != "", no.cast("bigint")).alias("no")).where("no is not null").distinct()


def chunk_completeness(spark: SparkSession, directory: str, pattern: str) -> DataFrame:
    """(n_contiguous, n_found): chunks 1,2,... up to the first gap, and all chunks seen.

    The window is in one task over one row per chunk file, a listing that the driver has held
    before (millions of files at most).
    """
    nos = chunk_numbers(spark, directory, pattern)
    ranked = nos.withColumn("pos", F.row_number().over(Window.orderBy("no")))
    return ranked.agg(
        F.count_if(F.col("no") == F.col("pos")).cast("bigint").alias("n_contiguous"),
        F.count("*").cast("bigint").alias("n_found"),
    )


def require_chunks(spark: SparkSession, directory: str, pattern: str) -> int:
    """Strict form: number of contiguous chunks, error when there are none."""
    row = chunk_completeness(spark, directory, pattern).first()
    if row is None or not row["n_contiguous"]:
        raise ValueError(f"no numbered chunks found under {directory}")
    return int(row["n_contiguous"])


# --- SRC-7 / SRC-8: JSON ------------------------------------------------------------------

def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    spread_to: int | None = None) -> DataFrame:
    """JSON lines (gz or not).  Inference reads all lines, widens conflicting scalars to string
    and puts unparsable lines into ``_corrupt_record``; pass a recorded schema to skip the
    inference pass on re-runs."""
    r = spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    if schema is not None:
        r = r.schema(schema)
    return spread(r.json(path), spread_to)


def valid_records(df: DataFrame, count_into: Observation | None = None) -> DataFrame:
    """Rows that parsed; the corrupt column is dropped.  With ``count_into``, whatever consumes
    the result also counts ``n_read`` and ``n_corrupt`` there.  Select data columns from the
    result (a bare ``count()`` would reference only the corrupt column, which Spark
    refuses on raw JSON/CSV)."""
    bad = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in df.columns else F.lit(False)
    if count_into is not None:
        df = df.observe(count_into, F.count(F.lit(1)).alias("n_read"), F.count_if(bad).alias("n_corrupt"))
    return df.where(~bad).drop("_corrupt_record") if "_corrupt_record" in df.columns else df


def corrupt_records(df: DataFrame) -> DataFrame:
    """Unparsable lines.  All columns are kept: Spark refuses a scan whose only required
    column is the corrupt-record column, so consume this with the data columns."""
    if "_corrupt_record" not in df.columns:
        return df.limit(0)
    return df.where(F.col("_corrupt_record").isNotNull())


def read_json_documents(spark: SparkSession, path: str, array_path: str = "_embedded.terms",
                        recursive: bool = True, one_per_line: bool = False) -> DataFrame:
    """Whole JSON documents (API pages) -> one row per array element.  A file holds one document
    over any number of lines, or, ``one_per_line``, one on each line (then files split)."""
    r = spark.read.option("multiLine", not one_per_line)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    docs = r.json(path)
    return docs.select(F.explode(F.col(array_path)).alias("t")).select("t.*")


# --- SRC-9 ------------------------------------------------------------------------------------

def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
