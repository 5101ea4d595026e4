"""Text files as ordered lines: columns ``file``, ``chunk``, ``pos``, ``line``.

``(chunk, pos)`` orders the lines of a file. For files, ``chunk`` is the byte offset of the
input split, so no chunk outgrows ``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from netaudit.functions.text import clean_csv_line
from netaudit.operators.matchjoin import file_join
from netaudit.operators.scan import lines_since, ordered_scan
from netaudit.session import checkpointed


def place() -> Column:
    """Position of a line in its file, comparable across chunks."""
    return F.struct("chunk", "pos")


def decoded_name(name: Column) -> Column:
    """File name as written on disk; names are URL-encoded in the file metadata."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def read_lines(
    spark: SparkSession, paths: str | Sequence[str], glob: str | None = None, named: str | None = None
) -> DataFrame:
    """Lines of the files whose base name fits ``glob`` and whose path matches ``named``.

    The path is tested before lines are numbered, so that other files are not opened.
    """
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    text = reader.text(paths if isinstance(paths, str) else list(paths))
    if named:
        text = text.filter(decoded_name(F.col("_metadata.file_path")).rlike(named))
    return text.select(
        decoded_name(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("chunk"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
    )


def read_marked_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of files in UTF-8 or, where a byte order mark says so, UTF-16; files of either kind are split freely.

    Files are cut at bytes 0A, which need not be line ends in UTF-16. The mark, the offset of a
    piece and the byte behind it are carried over the splits; they tell which cuts are line ends,
    and the pieces of a line are put together and decoded. Wrong bytes become a mark.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    pieces = text.select(
        decoded_name(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_block_start").alias("chunk"),
        F.monotonically_increasing_id().alias("pos"), F.col("value").cast("binary").alias("bytes"),
    )
    size = F.octet_length("bytes").cast("bigint")
    mark = F.first(F.hex(F.substring("bytes", 1, 2))).over(Window.partitionBy("file", "chunk").orderBy("pos"))
    placed = ordered_scan(
        pieces.withColumn("first", mark), ["file"], ["chunk"], "pos",
        carry={"mark": F.when((F.col("chunk") == 0) & F.col("first").isin("FFFE", "FEFF"), F.col("first"))},
        total_before={"offset": size + 1}, ahead={"next": F.hex(F.substring("bytes", 1, 1))},
    )
    plain = placed.filter("mark is null").select("file", "chunk", "pos", F.col("bytes").cast("string").alias("line"))

    little, at = F.col("mark") == "FFFE", F.col("offset") + size
    last = F.hex(F.substring("bytes", -1, 1))
    line_end = F.when(little, (at % 2 == 0) & (F.col("next") == "00")).otherwise((at % 2 == 1) & (last == "00") & F.col("next").isNotNull())
    wide = checkpointed(placed.filter("mark is not null").withColumn("ends", F.coalesce(line_end, F.lit(False))))
    numbered = ordered_scan(wide, ["file"], ["chunk"], "pos", total_before={"line": F.col("ends").cast("bigint")})
    whole = numbered.groupBy("file", "mark", "line").agg(
        F.array_sort(F.collect_list(F.struct("chunk", "pos", "bytes"))).alias("pieces"), F.max("ends").alias("ended")  # of one line
    )
    joined = F.unhex(F.concat_ws("0A", F.transform("pieces", lambda p: F.hex(p["bytes"]))))
    # The other byte of a line end is in the line behind it, or still in its own; the first line begins with the mark.
    begin = F.when(F.col("line") == 0, 3).when(little, 2).otherwise(1)
    end = F.octet_length("joined") - F.when(~little & F.col("ended"), 1).otherwise(0)
    length = F.greatest(end - begin + 1, F.lit(0))
    content = F.col("joined").substr(begin, length - length % 2)
    with java_charsets(spark):
        decoded = F.when(little, F.decode(content, "UTF-16LE")).otherwise(F.decode(content, "UTF-16BE"))
        wide_lines = whole.withColumn("joined", joined).select("file", F.col("pieces")[0]["chunk"].alias("chunk"), F.col("pieces")[0]["pos"].alias("pos"), decoded.alias("line"))
    return plain.unionByName(wide_lines)


def base_name(file: Column) -> Column:
    return F.substring_index(file, "/", -1)


def lines_of_table(df: DataFrame, file: Column, pos: Column, line: Column, chunk_lines: int = 100_000) -> DataFrame:
    """Lines held in a table, with a chunk number per ``chunk_lines`` positions."""
    return df.select(
        file.alias("file"),
        F.floor(pos / chunk_lines).cast("bigint").alias("chunk"),
        pos.cast("bigint").alias("pos"),
        line.alias("line"),
    )


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """Firewall configuration lines. The folder must hold exactly one configuration file."""
    # Fixed value: how a configuration file is named.
    name = r"[A-Z]{6}[0-9]{2}_[0-9\-_]+\.conf"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.conf").load(path)
    found = files.filter(base_name(decoded_name(F.col("path"))).rlike(name)).select("path").count()
    if found != 1:
        raise ValueError("config file is missing" if found == 0 else "only one config file may be stored")
    return read_lines(spark, path, "*.conf", rf"{name}[^/]*$")


def read_vpn_lines(spark: SparkSession, path: str, periods: Sequence[str]) -> DataFrame:
    """VPN log lines from files whose path names one of the periods, or is an ``access.log``."""
    return read_lines(spark, path, named="|".join([*periods, "access.log$"]))


def csv_cells(line: Column) -> Column:
    """Cells of one CSV line, as many as it has; empty cells are null, doubled quotes inside quotes are one."""
    raw = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))

    def cell(text: Column) -> Column:
        quoted = F.startswith(text, F.lit('"')) & F.endswith(text, F.lit('"')) & (F.length(text) > 1)
        inner = F.replace(text.substr(F.lit(2), F.length(text) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(quoted, inner).otherwise(text), F.lit(""))

    return F.transform(raw, cell)


@contextmanager
def java_charsets(spark: SparkSession) -> Iterator[None]:
    """All of Java's character sets for ``decode`` in DataFrames made inside; wrong bytes become a mark.

    An expression keeps what holds when it is made, so nothing is left of it in the session.
    """
    names = ["spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction"]
    before = {name: spark.conf.get(name, None) for name in names}
    for name in names:
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read_room_log(spark: SparkSession, path: str) -> DataFrame:
    """Room-entry CSV files in CP932: per file three leading lines, then a header line.

    Files may differ in their columns, so a row is a map from header name to cell; cells
    without a name are left out, and a short row has nulls. No byte of a CP932 character is a
    line break, so lines are read byte by byte and then decoded.
    """
    # The text source leaves the bytes of a line as they are.
    raw = spark.read.option("pathGlobFilter", "*.csv").text(path)
    with java_charsets(spark):
        lines = raw.select(
            decoded_name(F.col("_metadata.file_path")).alias("file"),
            F.col("_metadata.file_block_start").alias("chunk"),
            F.monotonically_increasing_id().alias("pos"),
            F.decode(F.col("value").cast("binary"), "windows-31j").alias("line"),
        )
    numbered = number_lines(lines).withColumn("cells", csv_cells(F.col("line")))
    headers = numbered.filter("line_no = 4").select("file", F.col("cells").alias("names"))
    pairs = F.transform("names", lambda name, i: F.struct(name.alias("key"), F.get("cells", i).alias("value")))
    return file_join(numbered.filter("line_no > 4"), headers).select(
        "file", "line_no", F.map_from_entries(F.filter(pairs, lambda p: p["key"].isNotNull())).alias("cells")
    )


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line_no``, one-based within the file."""
    return ordered_scan(lines, ["file"], ["chunk"], "pos", total={"line_no": F.lit(1)})


def csv_sections(lines: DataFrame, titles: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Cells of titled sections of sectioned CSV reports: ``file, section, row_no, cells``.

    ``titles`` gives each section its title text and number of rows. After the first line
    that holds the title one header line is skipped, and the next lines are split at commas.
    All sections are found in one scan; a section ends early where its title comes again.
    """
    cleaned = lines.withColumn("line", clean_csv_line(F.col("line")))
    marks = {section: F.contains("line", F.lit(title)) for section, (title, _) in titles.items()}
    scanned = ordered_scan(
        cleaned, ["file"], ["chunk"], "pos",
        since={f"after_{section}": lines_since(mark) for section, mark in marks.items()},
        total_before={f"seen_{section}": mark.cast("int") for section, mark in marks.items()},
    )
    section, row_no = F.lit(None).cast("string"), F.lit(None).cast("int")
    for name, (_, rows) in titles.items():
        inside = (F.col(f"seen_{name}") == 1) & F.col(f"after_{name}").between(1, rows) & ~marks[name]
        section = F.when(inside, F.lit(name)).otherwise(section)
        row_no = F.when(inside, F.col(f"after_{name}").cast("int")).otherwise(row_no)
    rows = scanned.select("file", section.alias("section"), row_no.alias("row_no"), F.split("line", ",", -1).alias("cells"))
    return rows.filter(F.col("section").isNotNull())


def csv_section(lines: DataFrame, title: str, rows: int, names: Sequence[str]) -> DataFrame:
    """One section with its cells named by position: ``file, row_no`` and the names."""
    return csv_sections(lines, {"section": (title, rows)}).select(
        "file", "row_no", *[F.try_element_at("cells", F.lit(i)).alias(name) for i, name in enumerate(names, 1)]
    )
