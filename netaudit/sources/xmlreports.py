"""XML firewall reports as one long table.

Columns ``file, report, table, place, cells``: ``place`` orders the rows of a table and
``cells`` maps column names to texts. Absent tags are absent keys, empty elements are ''.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from netaudit.constants import REPORT_NAMES, TOP_DESTINATIONS, TRAFFIC_SUMMARY, USER_REPORT, USER_SECTION
from netaudit.operators.scan import ordered_scan
from netaudit.session import checkpointed
from netaudit.sources.lines import base_name, decoded_name

ATTRIBUTE, TEXT = "@", "#text"
XML_OPTIONS = {
    "inferSchema": "false",
    "attributePrefix": ATTRIBUTE,
    "valueTag": TEXT,
    "ignoreSurroundingSpaces": "false",
}
TOP10_DESTINATIONS, USER_TRAFFIC = "top10Destinations", "trafficSummary"


def report_name(file: Column) -> Column:
    """Report name of a file: its base name without the time stamp, in either export form."""
    # The two forms of the time stamp.
    name = F.regexp_replace(base_name(file), r"^(.*?)-[0-9\-]+_[0-9]{4}\.xml", "$1")
    return F.regexp_replace(name, r"^(.*?)-[0-9\-]+\+[0-9]{4}_[0-9]+.xml", "$1")


def is_report(file: Column) -> Column:
    """Whether a file is one of the seven reports, by its base name."""
    return base_name(file).rlike("|".join(REPORT_NAMES))


def list_reports(spark: SparkSession, path: str) -> DataFrame:
    """XML files of a folder, listed without reading them: ``file, report, known``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(path)
    file = decoded_name(F.col("path"))
    return files.select(file.alias("file"), report_name(file).alias("report"), is_report(file).alias("known"))


def check_complete(files: DataFrame) -> None:
    """Raise unless the known files are exactly the seven reports, each once."""
    expected = files.sparkSession.createDataFrame([(name,) for name in REPORT_NAMES], "expected string")
    found = files.filter("known").groupBy("report").count()
    wrong = found.join(expected, F.col("report") == F.col("expected"), "full").filter(
        "expected is null or count is null or count <> 1"
    )
    names = wrong.select(F.coalesce("expected", "report").alias("name")).orderBy("name")
    shown = [row.name for row in names.take(20)]
    if shown:
        more = names.count() - len(shown)
        raise ValueError(f"input files are missing or not expected: {shown}" + (f" and {more} more" if more else ""))


def dated_export(report: str) -> str:
    """Pattern of the path of a dated export of a report."""
    # Fixed value: the time stamp of an export.
    return rf"{report}-[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}-[0-9]{{4}}[^/]*$"


def _text(value: Column, dtype: DataType) -> Column:
    """All text of an element, its own first and then that of its children by name."""
    if isinstance(dtype, ArrayType):
        return F.array_join(F.transform(value, lambda item: _text(item, dtype.elementType)), "")
    if not isinstance(dtype, StructType):
        return value.cast("string")
    own = [value[TEXT]] if TEXT in dtype.names else []
    inner = [_text(value[f.name], f.dataType) for f in dtype.fields if f.name != TEXT and not f.name.startswith(ATTRIBUTE)]
    return F.when(value.isNotNull(), F.concat_ws("", *own, *inner))


def _single(name: str, value: Column, dtype: DataType) -> Column:
    return F.array(F.struct(F.lit(name).alias("key"), _text(value, dtype).alias("value")))


def _numbered(name: str, values: Column, dtype: DataType) -> Column:
    def entry(item: Column, i: Column) -> Column:
        key = F.when(F.size(values) > 1, F.concat(F.lit(name), (i + 1).cast("string"))).otherwise(name)
        return F.struct(key.alias("key"), _text(item, dtype).alias("value"))

    return F.coalesce(F.transform(values, entry), F.array())


def cells_of(row: Column, dtype: DataType) -> Column:
    """Child tags of one element as a map; a tag that occurs n > 1 times becomes tag1 … tagn."""
    fields = [f for f in dtype.fields if not f.name.startswith(ATTRIBUTE)] if isinstance(dtype, StructType) else []
    entries = [
        _numbered(f.name, row[f.name], f.dataType.elementType)
        if isinstance(f.dataType, ArrayType)
        else _single(f.name, row[f.name], f.dataType)
        for f in fields
        if f.name != TEXT
    ]
    if not entries:
        return F.create_map().cast("map<string,string>")
    return F.map_from_entries(F.filter(F.concat(*entries), lambda e: e["value"].isNotNull()))


NO_ROWS = "array<map<string,string>>"


def _elements(value: Column, dtype: DataType) -> tuple[Column, DataType]:
    if isinstance(dtype, ArrayType):
        return value, dtype.elementType
    return F.when(value.isNotNull(), F.array(value)), dtype


def id_rows(element: Column, dtype: DataType) -> Column:
    """Cells of the descendant ``id`` elements, one map per element."""
    found = [F.array().cast(NO_ROWS)]
    for field in dtype.fields if isinstance(dtype, StructType) else []:
        elements, inner = _elements(element[field.name], field.dataType)
        if field.name == "id":
            rows = F.transform(elements, lambda e: cells_of(e, inner))
        elif isinstance(inner, StructType):
            rows = F.flatten(F.transform(elements, lambda e: id_rows(e, inner)))
        else:
            continue
        found.append(F.coalesce(rows, F.array().cast(NO_ROWS)))
    return F.concat(*found)


def rows_of_tables(tables: DataFrame, dtype: StructType) -> DataFrame:
    """Rows of ``table`` elements.

    ``tables`` has the element as struct ``element`` of type ``dtype``, an ordering struct or
    number ``at`` and any other columns, which are kept. The traffic summary is itself a row,
    other tables have one per ``id``.
    """
    element = F.col("element")
    own = cells_of(element, StructType([f for f in dtype.fields if f.name != "id"]))
    name = element[f"{ATTRIBUTE}name"]
    kept = [c for c in tables.columns if c not in ("element", "at")]
    all_rows = F.when(name == TRAFFIC_SUMMARY, F.array(own)).otherwise(id_rows(element, dtype))
    return tables.select(*kept, name.alias("table"), "at", F.posexplode(all_rows).alias("row", "cells")).select(
        *kept, "table", F.struct("at", "row").alias("place"), "cells"
    )


def user_sections(rows: DataFrame, of_users: Column | None = None) -> DataFrame:
    """Tables of the per-user sections under their common names, the section name as ``rank`` cell.

    ``rows`` carries the section name in ``section``. Where ``of_users`` is given and does not
    hold, rows stay as they are; where it does, those outside of sections are left out.
    """
    ranked = F.map_concat(
        F.map_filter("cells", lambda key, _: key != "rank"), F.create_map(F.lit("rank"), F.col("section"))
    )
    wanted = F.col("table").isin(TRAFFIC_SUMMARY, TOP_DESTINATIONS)
    destination = F.col("table") == TOP_DESTINATIONS
    name = F.when(destination, TOP10_DESTINATIONS).otherwise(USER_TRAFFIC)
    if of_users is not None:
        wanted = ~of_users | (F.col("section").isNotNull() & wanted)
        destination, name = of_users & destination, F.when(of_users, name).otherwise(F.col("table"))
    return rows.filter(wanted).select(
        *[c for c in rows.columns if c not in ("table", "cells", "section")],
        name.alias("table"),
        F.when(destination, ranked).otherwise(F.col("cells")).alias("cells"),
    )


def rows_of_sections(sections: DataFrame, dtype: StructType) -> DataFrame:
    """Rows of per-user section elements, under the tables' common names.

    ``sections`` has the element as struct ``element`` of type ``dtype``, ``at`` and any other
    columns, which are kept.
    """
    kept = [c for c in sections.columns if c not in ("element", "at")]
    tables, inner = _elements(F.col("element.table"), dtype["table"].dataType)
    listed = sections.select(
        *kept, F.col(f"element.`{ATTRIBUTE}name`").alias("section"), "at", F.posexplode(tables).alias("t", "table")
    ).select(*kept, "section", F.struct("at", "t").alias("at"), F.col("table").alias("element"))
    return user_sections(rows_of_tables(listed, inner))


# Text of a file between two ends of ``id`` elements. Tags in it, with attributes in quotes that may hold an angle bracket.
ID_END = "</id>"
_ATTRIBUTES = r"(?:\s(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)?"
_TABLE_TAG = rf"<table{_ATTRIBUTES}>|</table\s*>"
_SECTION_TAG = rf"<{USER_SECTION}{_ATTRIBUTES}>|</{USER_SECTION}\s*>"
_ID_TAG = rf"<id{_ATTRIBUTES}/?>"
_CHILD = r"(?s)<([A-Za-z_][\w.:-]*)(?:\s(?:\"[^\"]*\"|'[^']*'|[^>\"'])*?)?(?:/>|>(.*?)</\1\s*>)"
_SUMMARY = rf"(?s)<table\s[^>]*name\s*=\s*[\"']{TRAFFIC_SUMMARY}[\"'][^>]*>(.*?)(?:</table\s*>|\z)"
#: Elements of a block, as a power of two.
BLOCK_BITS = 16
#: State behind the end of a table or section.
CLOSED = "\x00"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """What ``use`` makes of a value. An expression that stands in a function of array elements is run for each of them; this one runs once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unescaped(text: Column) -> Column:
    """Text with its references to characters put in."""
    return _once(text, _unescaped)


def _unescaped(text: Column) -> Column:
    numbers = F.array_distinct(F.regexp_extract_all(text, F.lit("&#(x?[0-9A-Fa-f]+);"), 1))

    def character(number: Column) -> Column:
        hexadecimal = F.when(number.startswith("x"), F.substring(number, 2, 8)).otherwise(F.conv(number, 10, 16))
        return F.decode(F.unhex(F.lpad(hexadecimal, 8, "0")), "UTF-32")

    found = F.aggregate(numbers, text, lambda done, n: F.replace(done, F.concat(F.lit("&#"), n, F.lit(";")), character(n)))
    for name, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        found = F.replace(found, F.lit(f"&{name};"), F.lit(sign))
    return found


def child_cells(content: Column) -> Column:
    """Child tags in the content of an element as a map, like :func:`cells_of`; a child's text is all text in it, in order.

    A child does not hold an element of its own name.
    """
    def keys(names: Column) -> Column:
        def key(name: Column, i: Column) -> Column:
            before = F.size(F.filter(F.slice(names, 1, i + 1), lambda n: n == name))
            return F.when(F.size(F.filter(names, lambda n: n == name)) > 1, F.concat(name, before.cast("string"))).otherwise(name)

        return F.transform(names, key)

    def first(entries: Column) -> Column:
        return F.filter(entries, lambda e, i: F.array_position(F.transform(F.slice(entries, 1, i + 1), lambda x: x["key"]), e["key"]) == i + 1)

    def cells(text: Column) -> Column:
        names = F.regexp_extract_all(text, F.lit(_CHILD), 1)
        texts = F.transform(F.regexp_extract_all(text, F.lit(_CHILD), 2), lambda t: unescaped(F.regexp_replace(t, "<[^>]*>", "")))
        return _once(F.arrays_zip(_once(names, keys).alias("key"), texts.alias("value")), first)

    return F.map_from_entries(_once(content, cells))


def _state(tag: Column) -> Column:
    """What a table's or section's tag opens: its name, or that it is closed."""
    return _once(tag, _state_of)


def _state_of(tag: Column) -> Column:
    name = F.regexp_extract(tag, r"""\sname\s*=\s*(?:"([^"]*)"|'([^']*)')""", 0)
    value = unescaped(F.regexp_extract(name, r"""^\sname\s*=\s*["']([\s\S]*)["']$""", 1))
    return F.when(tag.startswith("</") | tag.endswith("/>"), F.lit(CLOSED)).otherwise(value)


def _last(tags: Column, pattern: str) -> Column:
    return F.try_element_at(F.filter(tags, lambda t: t.rlike(f"^(?:{pattern})$")), F.lit(-1))


def read_id_rows(spark: SparkSession, path, glob: str = "*.xml") -> DataFrame:
    """Rows of the reports' tables, read element by element: ``file, report, section, table, place, cells``.

    A file is cut behind its ``id`` elements, so one table may hold any number of them and its
    file is read by many tasks. What table and section a row is in follows from the last of
    their tags before it, which is carried over the cuts and splits. The traffic summary is
    itself a row. Files that are no reports are left out.
    """
    text = spark.read.option("lineSep", ID_END).option("pathGlobFilter", glob).text(path)
    file = decoded_name(F.col("_metadata.file_path"))
    pieces = text.filter(is_report(file)).select(
        file.alias("file"), F.col("_metadata.file_block_start").alias("chunk"), F.monotonically_increasing_id().alias("pos"),
        F.regexp_replace("value", "(?s)<!--.*?-->", "").alias("value"),
    )
    tags = F.regexp_extract_all(F.col("value"), F.lit(f"{_TABLE_TAG}|{_SECTION_TAG}|{_ID_TAG}"), 0)
    summaries = F.regexp_extract_all(F.col("value"), F.lit(_SUMMARY), 1)
    content = F.regexp_extract("value", rf"(?s)^.*<id(?:\s[^>]*)?(?<!/)>(.*)$", 1)

    def row(tag: Column, i: Column) -> Column:
        before = F.slice("tags", 1, i + 1)
        table, section = _state(_last(before, _TABLE_TAG)), _state(_last(before, _SECTION_TAG))
        is_id = tag.rlike("^<id")
        nth = F.size(F.filter(before, lambda t: _state(t) == TRAFFIC_SUMMARY))
        inside = F.when(is_id & tag.endswith("/>"), "").when(is_id, content).otherwise(F.try_element_at(summaries, nth))
        return F.when(
            is_id | (F.col("tags")[i].startswith("<table") & (_state(tag) == TRAFFIC_SUMMARY)),
            F.struct(i.alias("at"), is_id.alias("is_id"), table.alias("table"), section.alias("section"), child_cells(inside).alias("cells")),
        )

    found = F.filter(F.transform("tags", row), lambda r: r.isNotNull())
    held = pieces.withColumn("tags", tags).select("file", "chunk", "pos", "tags", found.alias("rows")).select(
        "file", report_name(F.col("file")).alias("report"), "chunk", "pos", "rows", _state(_last(F.col("tags"), _TABLE_TAG)).alias("_table"), _state(_last(F.col("tags"), _SECTION_TAG)).alias("_section"),
    )
    # Elements are short, so a split has many; windows run inside blocks of them, over rows written out once.
    held = checkpointed(held.withColumn("block", F.shiftright("pos", BLOCK_BITS)))
    carried = ordered_scan(held, ["file"], ["chunk", "block"], "pos", carry_before={"in_table": F.col("_table"), "in_section": F.col("_section")})
    rows = carried.select("file", "report", "chunk", "pos", "in_table", "in_section", F.explode("rows").alias("r")).select(
        "file", "report", F.nullif(F.coalesce("r.section", "in_section"), F.lit(CLOSED)).alias("section"),
        F.coalesce("r.table", "in_table").alias("table"),
        F.struct("file", F.col("chunk").alias("n"), F.col("pos").alias("t"), F.col("r.at").alias("row")).alias("place"), "r.cells", "r.is_id",
    )
    return rows.filter((F.col("table") != CLOSED) & ~(F.col("is_id") & (F.col("table") == TRAFFIC_SUMMARY))).drop("is_id")


def read_tables(spark: SparkSession, path, glob: str = "*.xml") -> DataFrame:
    """Long table of the ``table`` elements of the files, without per-user sections."""
    rows = read_id_rows(spark, path, glob)
    return rows.filter(F.col("report") != USER_REPORT).drop("section")


def read_reports(spark: SparkSession, path) -> DataFrame:
    """Long table of all reports of a folder, the files and their rows read once."""
    return user_sections(read_id_rows(spark, path), F.col("report") == USER_REPORT)


def rows_of_xml_column(df: DataFrame, xml: str, schema: StructType, at: str, row_tag: str = "table") -> DataFrame:
    """Rows of XML elements held as text in a column: tables or per-user sections.

    ``at`` orders the elements; the other columns are kept.
    """
    parsed = df.withColumn("element", F.from_xml(xml, schema, XML_OPTIONS | {"rowTag": row_tag}))
    elements = parsed.drop(xml).withColumnRenamed(at, "at")
    return rows_of_tables(elements, schema) if row_tag == "table" else rows_of_sections(elements, schema)


def section_schema(table: StructType) -> StructType:
    """Schema of a per-user section of ``table`` elements."""
    return StructType().add(f"{ATTRIBUTE}name", StringType()).add("table", ArrayType(table))


def table_schema(columns: dict[str, bool], own: list[str] = ()) -> StructType:
    """Schema of a ``table`` element: ``id`` columns (true where a tag may repeat) and own columns."""
    row = StructType()
    for name, repeats in columns.items():
        row = row.add(name, ArrayType(StringType()) if repeats else StringType())
    schema = StructType().add(f"{ATTRIBUTE}name", StringType()).add("id", ArrayType(row))
    for name in own:
        schema = schema.add(name, StringType())
    return schema


def table_columns(rows: DataFrame, report: str, table: str) -> list[str]:
    """Column names of one table, from its cells."""
    of_table = rows.filter((F.col("report") == report) & (F.col("table") == table))
    names = of_table.select(F.explode(F.map_keys("cells")).alias("name")).distinct()
    return sorted(row.name for row in names.collect())


def table_view(rows: DataFrame, report: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """One report table with a column per cell name (looked up unless given)."""
    columns = table_columns(rows, report, table) if columns is None else columns
    of_table = rows.filter((F.col("report") == report) & (F.col("table") == table))
    return of_table.select("place", *[F.try_element_at("cells", F.lit(c)).alias(c) for c in columns])
