"""Landing-folder scans: CSV files with their own headers (plain or gzip,
UTF-8 with Latin-1 fallback), stage listings and positional loads.

A multi-file CSV read binds every file to the first file's header, so the
files are read as lines instead, once, into a table; each line meets one small
row per split of its file (header, encoding, lines before) by a join and is
cut into cells by an expression.  All cells stay text, which keeps leading
zeros and decimal text exactly as landed.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from claimlake.functions.text import file_type
from claimlake.operators.joins import broadcast_if_small
from claimlake.session import checkpoint_dir, write_work, written


def _decoded(uri):
    """A ``_metadata.file_path`` without its percent codes, as readers take it."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def below(spark: SparkSession, uri, root: str):
    """Name of a file relative to ``root``: decoded, without scheme and host, for any file system.

    ``uri`` is a ``_metadata.file_path`` (percent-encoded).
    """
    hp = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = hp.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hp).toUri().getPath().rstrip("/")
    path = _decoded(F.regexp_replace(uri, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""))
    return F.regexp_replace(path, "^/*" + re.escape(base.lstrip("/")) + "/", "")


def list_landing(spark: SparkSession, root: str) -> DataFrame:
    """SRC-5: every file under ``root``: relative name, size, modification time.

    Only metadata columns are selected, so file contents are never read.
    """
    root = root.rstrip("/")
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
               .select("path", F.col("_metadata.file_path").alias("uri"), "length", "modificationTime"))
    return df.select("path", below(spark, F.col("uri"), root).alias("file_name"), F.col("length").alias("size"),
                     F.col("modificationTime").cast("timestamp_ntz").alias("modification_time"))


# A cell: quoted (doubled quotes inside, anything up to the comma after it), or unclosed to the end, bare, or empty.
# Possessive throughout, so that long cells and wide lines need no backtracking.
_QUOTED = r'"(?:[^"]++|"")*+'
_CELL = r'(?:' + _QUOTED + r'(?:"[^,]*+|\z)|[^",][^,]*+|)'
_OPENS = r'(?:' + _CELL + r',)*+' + _QUOTED + r'\z'
_WHOLE = r'\A"((?:[^"]++|"")*+)"?\z'


def land_lines(spark: SparkSession, root: str, pattern: str = "(?i).*\\.csv(\\.gz)?$", paths: list[str] | None = None,
               work: str | None = None) -> DataFrame:
    """The lines of every CSV file, read once and kept as a table in ``work`` (by default a fresh shared folder).

    A line keeps its file, its split and its place there, so that all later
    steps agree on them however often a task is repeated, and two marks that
    say where it leaves a reader who starts it outside (``open``) or inside
    (``inside``) a quoted cell: whether such a cell is still open at its end.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.[cC][sS][vV]*")
    lines = reader.text(paths) if paths else reader.text(root.rstrip("/"))
    v = F.col("value")
    lines = (lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
                  .filter(_decoded(F.col("path")).rlike(pattern)).withColumn("id", F.monotonically_increasing_id()))
    lines = lines.select("path", "at", "id", v.cast("binary").alias("line"), F.is_valid_utf8(v).alias("utf8"), (F.length(F.trim(v)) == 0).alias("blank"),
                         v.rlike(r"\A" + _OPENS).cast("int").alias("open"),
                         v.rlike(r'\A(?:[^"]++|"")*+(?:\z|"[^,]*+,' + _OPENS + ")").cast("int").alias("inside"))
    work = work or checkpoint_dir(spark).rstrip("/") + f"/landing-lines-{uuid.uuid4().hex}"
    write_work(lines, work)
    return spark.read.schema(lines.schema).parquet(work)


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split of a file: its lines, those of earlier splits, and what the file as a whole is like (its header by the line's id)."""
    splits = lines.groupBy("path", "at").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"), F.max("open").alias("opens"),
                                             F.max("blank").alias("blanks"), F.bool_and("utf8").alias("utf8"), F.min(F.when(~F.col("blank"), F.col("id"))).alias("head"))
    whole, earlier = Window.partitionBy("path"), Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("path", "at", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                         F.bool_and("utf8").over(whole).alias("utf8"), F.min_by("head", F.when(F.col("head").isNotNull(), F.col("at"))).over(whole).alias("head"),
                         ((F.max("opens").over(whole) == 0) & ~F.max("blanks").over(whole)).alias("plain"))


def _text(line, utf8):
    """A line of a file: UTF-8, or ISO-8859-1 as soon as one line of the file is not valid UTF-8."""
    return F.when(utf8, line.cast("string")).otherwise(F.decode(line, "ISO-8859-1"))


def _followed(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """``after0``, ``after1``: whether a cell is open after the row, for a reader who enters its group outside or inside one.

    A row keeps, turns or sets that state: it is the value that the last
    setting row left, turned as often as rows after it turn it.
    """
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    turns = F.sum(F.when((F.col("open") == 1) & (F.col("inside") == 0), 1).otherwise(0)).over(w)
    df = df.withColumn("_turns", turns)
    df = df.withColumn("_set", F.last(F.when(F.col("open") == F.col("inside"), F.col("open") - F.col("_turns")), True).over(w))
    after = lambda entry: F.pmod(F.col("_turns") + F.coalesce("_set", F.lit(entry)), F.lit(2)).cast("int")
    return df.withColumn("after0", after(0)).withColumn("after1", after(1)).drop("_turns", "_set")


def _joined_records(lines: DataFrame) -> DataFrame:
    """(path, number, text) of files with cells over several lines or with blank lines; the header is number 1.

    Work is dealt by split.  A quote that is never closed would take in the
    rest of its file: the lines after the one that opens it stay records of their own.
    """
    rows = _followed(lines, ["path", "at"], "id")
    splits = rows.groupBy("path", "at").agg(F.max_by("after0", "id").alias("open"), F.max_by("after1", "id").alias("inside"))
    along = Window.partitionBy("path").orderBy("at")
    splits = _followed(splits, ["path"], "at").select("path", "at", F.lag("after0", 1, 0).over(along).alias("entry"),
                                                      F.last("after0").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("unclosed"))
    w = Window.partitionBy("path", "at").orderBy("id")
    rows = rows.join(splits, ["path", "at"])
    rows = rows.withColumn("_out", F.when(F.col("entry") == 0, F.col("after0")).otherwise(F.col("after1")))
    rows = rows.withColumn("_in", F.coalesce(F.lag("_out").over(w), "entry"))
    rows = rows.filter(~F.col("blank") | (F.col("_in") == 1)).withColumn("_start", F.when(F.col("_in") == 0, 1).otherwise(0))
    starts = rows.groupBy("path", "at").agg(F.sum("_start").alias("_n"), F.max(F.when(F.col("_start") == 1, F.col("place"))).alias("_last"))
    whole = Window.partitionBy("path")
    starts = starts.select("path", "at", F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                           F.sum("_n").over(whole).alias("_all"), F.max("_last").over(whole).alias("_last"))
    rows = rows.withColumn("_number", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))).join(starts, ["path", "at"])
    tail = (F.col("unclosed") == 1) & (F.col("place") > F.col("_last"))
    number = F.when(tail, F.col("_all") + F.col("place") - F.col("_last")).otherwise(F.col("_before") + F.col("_number"))
    rows = rows.filter(~(tail & F.col("blank")))
    piece = F.struct("at", "id", _text(F.col("line"), F.col("utf8_file")).alias("text"))
    return (rows.groupBy("path", number.alias("number"))
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["text"]), "\n").alias("text")))


def _cells(text):
    def plain(c):
        return F.when(c.startswith('"') & c.rlike(_WHOLE), F.replace(F.regexp_extract(c, _WHOLE, 1), F.lit('""'), F.lit('"'))).otherwise(c)
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(",(" + _CELL + ")"), 1), plain)


def _names(header):
    """Header cells as keys: trimmed, an empty one by its position, a repeated one with a number."""
    names = F.transform(_cells(F.regexp_replace(header, "^\ufeff", "")), lambda c, i: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.concat(F.lit("_c"), i)))

    def numbered(a, mark):
        again = lambda n, i: F.size(F.filter(F.slice(a, F.lit(1), i), lambda x: x == n))
        one = F.transform(a, lambda n, i: F.when(again(n, i) > 0, F.concat(n, F.lit(mark), again(n, i))).otherwise(n))
        return F.when(F.size(F.array_distinct(a)) < F.size(a), one).otherwise(a)
    return names, numbered


def landing_records(lines: DataFrame, work: str | None = None) -> DataFrame:
    """(path, number, cells, names) of the data records of ``land_lines``: number is 1-based; the header is no record.

    Lines meet one small row per split of their file; these rows and the headers are written once (beside ``work``) and
    broadcast if those tables are small, so that lines are not moved and sorted by split.  Only files with a cell
    over several lines, or with blank lines, take the longer way; their
    records are written once (beside ``work``), as every use would put them together again.
    """
    beside = work or checkpoint_dir(lines.sparkSession).rstrip("/") + f"/landing-{uuid.uuid4().hex}"
    splits = written(_splits(lines), "landing-splits", beside + "-splits")
    ids = broadcast_if_small(splits.select(F.col("head").alias("id")).distinct(), [beside + "-splits"])
    heads = written(lines.select("path", "id", F.col("line").alias("head")).join(ids, "id").drop("id"), "landing-heads", beside + "-heads")
    splits = splits.drop("head").join(heads, "path", "left")
    known = lines.drop("utf8").join(broadcast_if_small(splits.withColumnRenamed("utf8", "utf8_file"), [beside + "-splits", beside + "-heads"]), ["path", "at"])
    place = F.col("id") - F.col("first") + F.col("before")
    records = known.filter("plain").filter(place > 0).select("path", place.alias("number"), _text(F.col("line"), F.col("utf8_file")).alias("text"),
                                                            _text(F.col("head"), F.col("utf8_file")).alias("header"))
    if not splits.filter(~F.col("plain")).isEmpty():
        joined = written(_joined_records(known.filter(~F.col("plain")).withColumn("place", place)), "landing-records", work and work + "-records")
        heads = joined.filter("number = 1").select("path", F.col("text").alias("header"))
        records = records.unionByName(joined.filter("number > 1").withColumn("number", F.col("number") - 1).join(heads, "path"))
    names, numbered = _names(F.col("header"))
    return (records.select("path", F.col("number").cast("bigint"), _cells(F.col("text")).alias("cells"), names.alias("names"))
                   .withColumn("names", numbered(F.col("names"), "_")).withColumn("names", numbered(F.col("names"), "_again")))


def unique_names(row: list[str]) -> list[str]:
    """Header cells as keys: trimmed, an empty one by its position, a repeated one with a number."""
    names, seen = [], {}
    for i, n in enumerate(row):
        n = n.strip() or f"_c{i}"
        if n in seen:
            seen[n] += 1
            n = f"{n}_{seen[n]}"
        else:
            seen[n] = 0
        names.append(n)
    return names


def _tenant(rel, partition_dirs: bool):
    tpa = F.when(F.instr(rel, "/") > 0, F.split_part(rel, F.lit("/"), F.lit(1)))
    return F.regexp_replace(tpa, "^[^=/]+=", "") if partition_dirs else tpa


def read_landing_csv(spark: SparkSession, root: str, mode: str = "PERMISSIVE", paths: list[str] | None = None,
                     partition_dirs: bool = False, work: str | None = None) -> DataFrame:
    """SRC-1/2/3 + BRZ-5: rows of every landing CSV as JSON objects of strings.

    Output: tpa (first folder under ``root``; files directly under ``root``
    have none), file_name (relative), file_row_number (1-based, data rows),
    file_type, raw_data.  Empty cells are nulls under their key; key names keep
    their spelling.  The files are read once (``land_lines``); no file name
    reaches the driver.  Rows with too few cells are filled with nulls and
    cells beyond the header dropped (PERMISSIVE), such rows go (DROPMALFORMED)
    or stop the read (FAILFAST).  ``paths`` limits the scan to given files
    (streaming micro-batches); ``partition_dirs`` reads ``tpa=x`` folder names
    as tenant ``x``; ``work`` names the folder of the lines (and, with ``-splits``, ``-heads`` and ``-records`` added, of what is known of their splits, of headers and of joined records).
    """
    records = landing_records(land_lines(spark, root, paths=paths, work=work), work)
    k, n = F.size("names"), F.size("cells")
    if mode.upper() == "DROPMALFORMED":
        records = records.filter(k == n)
    cells = F.transform(F.slice(F.concat("cells", F.array_repeat(F.lit(None).cast("string"), F.greatest(k - n, F.lit(0)))), F.lit(1), k),
                        lambda c: F.nullif(c, F.lit("")))
    if mode.upper() == "FAILFAST":
        cells = F.when(k == n, cells).otherwise(F.raise_error(F.concat(F.lit("uneven row "), F.col("number"), F.lit(" of "), F.col("path"))).cast("array<string>"))
    rel = below(spark, F.col("path"), root.rstrip("/"))
    return records.select(_tenant(rel, partition_dirs).alias("tpa"), rel.alias("file_name"), F.col("number").alias("file_row_number"),
                          file_type(rel).alias("file_type"), F.to_json(F.map_from_arrays("names", cells), {"ignoreNullFields": "false"}).alias("raw_data"))


def landing_outcomes(spark: SparkSession, root: str, partition_dirs: bool = False, work: str | None = None) -> DataFrame:
    """BRZ-8: one row per CSV file under ``root``, header-only ones too, with what reading it gives.

    (tpa, file_name, size, rows_read, short_rows, long_rows, result): the
    result text is what the file queue takes.  Files of no bytes are in no
    listing of Spark's and have no row; a queued file without one was not read.
    """
    records = landing_records(land_lines(spark, root, work=work), work)
    k, n = F.size("names"), F.size("cells")
    read = records.groupBy("path").agg(F.count(F.lit(1)).alias("rows_read"), F.count_if(n < k).alias("short_rows"), F.count_if(n > k).alias("long_rows"))
    read = read.select(below(spark, F.col("path"), root.rstrip("/")).alias("file_name"), "rows_read", "short_rows", "long_rows")
    files = list_landing(spark, root).filter(F.col("file_name").rlike("(?i).*\\.csv(\\.gz)?$"))
    j = files.join(read, "file_name", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    result = (F.when(F.col("rows_read").isNull(), F.lit("SUCCESS: no data rows"))
               .otherwise(F.concat(F.lit("SUCCESS: "), F.col("rows_read"), F.lit(" rows, uneven "), F.col("short_rows") + F.col("long_rows"))))
    return j.select(_tenant(F.col("file_name"), partition_dirs).alias("tpa"), "file_name", "size", zero("rows_read"), zero("short_rows"), zero("long_rows"), result.alias("result"))


def load_csv_as(spark: SparkSession, path: str, schema: T.StructType | str, mode: str = "ABORT",
                header: bool = True, booleans_yn: bool = True) -> DataFrame:
    """SRC-6/7: positional typed CSV load; trims, empty -> NULL, Y/N -> boolean.

    mode: ABORT (fail on a bad row), CONTINUE (skip bad rows) or PERMISSIVE
    (bad values become NULL).  Values are read as text and cast with
    ``try_cast``, so a bad value is detected per cell.
    """
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    spark_mode = {"ABORT": "FAILFAST", "CONTINUE": "DROPMALFORMED"}.get(mode.upper(), mode.upper())
    strings = T.StructType([T.StructField(f.name, T.StringType()) for f in st.fields])
    df = (spark.read.schema(strings).option("header", header).option("quote", '"').option("escape", '"')
               .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
               .option("mode", spark_mode).csv(path))
    cols, bad = [], None
    for f in st.fields:
        v = F.nullif(F.trim(F.col(f.name)), F.lit(""))
        if isinstance(f.dataType, T.StringType):
            cols.append(v.alias(f.name))
            continue
        if isinstance(f.dataType, T.BooleanType) and booleans_yn:
            u = F.upper(v)
            typed = (F.when(u.isin("Y", "YES", "TRUE", "1"), F.lit(True))
                      .when(u.isin("N", "NO", "FALSE", "0"), F.lit(False)))
        else:
            typed = v.try_cast(f.dataType)
        wrong = v.isNotNull() & typed.isNull()
        bad = wrong if bad is None else bad | wrong
        if spark_mode == "FAILFAST":
            typed = F.when(~wrong, typed).otherwise(
                F.raise_error(F.concat(F.lit(f"bad value for {f.name}: "), v)).cast(f.dataType))
        cols.append(typed.alias(f.name))
    if spark_mode == "DROPMALFORMED" and bad is not None:
        df = df.filter(~bad)
    return df.select(*cols)


def to_raw(df: DataFrame, order_by: list[str], id_col: str = "row_number",
           upper_keys: bool = True) -> DataFrame:
    """SRC-8: object of all columns (as strings) plus a dense row number."""
    from claimlake.operators.sequence import with_sequence_id
    fields = [F.col(c).cast("string").alias(c.upper() if upper_keys else c) for c in df.columns]
    out = df.select(*order_by, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("raw_data"))
    return with_sequence_id(out, order_by, id_col).drop(*order_by)
