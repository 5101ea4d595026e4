"""Asset, address, allow, deny and network registers, and DHCP lease files.

Every register row carries ``seq``, a struct that orders rows by register, file and line, so
that "the first row" has one meaning without a global row number.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from netaudit.constants import BLANK_HOST, DHCP_MARKERS
from netaudit.functions.net import has_mac, is_ip
from netaudit.functions.text import token, trim_blanks
from netaudit.operators.matchjoin import file_join
from netaudit.sinks.versions import register_folder
from netaudit.sources.lines import number_lines, read_marked_lines

# Column names of the registers.
STATIC_SCHEMA = "`IPアドレス` string, `ホスト名` string, `設置場所` string, `管理者` string, `用途` string"
ASSET_SCHEMA = "`使用者名` string, `コンピュータ名` string, `部署名` string, `廃棄日` string"
ALLOW_SCHEMA = "domain string, Description1 string"
DENY_SCHEMA = "ip string, hostName string, macAddress string"
WHOIS_SCHEMA = "User string, ip string"
VPN_SCHEMA = "ip string, user string"
VPN_LOCAL_SCHEMA = "ip string"
RANGE_SCHEMA = "interface string, lo long, hi long"
DELETED_ON = "削除日"

DEVICE_COLUMNS = ["ip", "hostName", "user", "description", "macAddress"]


def sequence(rank: int, file: Column, chunk: Column, pos: Column) -> Column:
    """Order of a register row: register rank, then file, chunk and position."""
    return F.struct(
        F.lit(rank).alias("rank"), file.alias("file"), chunk.cast("bigint").alias("chunk"), pos.cast("bigint").alias("pos")
    )


def read_register(
    spark: SparkSession, path: str, schema: str, rank: int = 0, fmt: str = "json", version: int | None = None, **options
) -> DataFrame:
    """Register snapshot with its row order in ``seq``, of the last version or of ``version``.

    A folder without versions is read as it is. JSON snapshots leave null fields out, so the schema is always given. Files that hold one
    JSON array need ``multiLine=True``; snapshots written here are one object per line.
    """
    rows = spark.read.schema(schema).options(**options).format(fmt).load(register_folder(spark, path, version))
    return rows.select(
        "*",
        sequence(
            rank,
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        ).alias("seq"),
    )


def read_scalars(spark: SparkSession, path: str, name: str = "ip") -> DataFrame:
    """Register snapshot that is one JSON array of texts per file."""
    arrays = spark.read.text(register_folder(spark, path), wholetext=True).select(F.from_json("value", "array<string>").alias("items"))
    return arrays.select(F.explode("items").alias(name)).filter(F.col(name).isNotNull())


def read_parameters(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """Key-value register ``ID, Item``; an ID may have many items."""
    return read_register(spark, path, "ID string, Item string", fmt="csv", version=version, header=True)


def parameter_items(parameters: DataFrame, key: str) -> DataFrame:
    return parameters.filter(F.col("ID") == key).select(trim_blanks(F.col("Item")).alias("Item"), "seq")


def without_leading_rows(register: DataFrame, rows: int = 2) -> DataFrame:
    """A register without the first rows of each file, which explain its columns."""
    placed = register.withColumns({name: F.col(f"seq.{name}") for name in ("file", "chunk", "pos")})
    return number_lines(placed).filter(F.col("line_no") > rows).select(*register.columns)


def read_settings(spark: SparkSession, path: str) -> DataFrame:
    """Headerless parameter file ``itemName, data``."""
    return spark.read.schema("itemName string, data string").csv(path)


def valid_on(register: DataFrame, day: date, column: str = DELETED_ON) -> DataFrame:
    """Rows not deleted before ``day``."""
    return register.filter(F.col(column).isNull() | (F.col(column) >= F.lit(day)))


def static_devices(register: DataFrame) -> DataFrame:
    """Static-address rows as devices; nameless rows and the DHCP marker rows are left out."""
    host = F.col("ホスト名")
    return register.filter(host.isNotNull() & ~host.isin(DHCP_MARKERS)).select(
        F.col("IPアドレス").alias("ip"),
        host.alias("hostName"),
        F.coalesce("管理者", "用途").alias("user"),
        F.col("設置場所").alias("description"),
        "seq",
    )


def assets_in_use(register: DataFrame) -> DataFrame:
    """Assets not disposed of: ``user, description, key, seq`` with the lower-case computer name."""
    return register.filter(F.col("廃棄日").isNull()).select(
        F.col("使用者名").alias("user"),
        F.col("部署名").alias("description"),
        F.lower("コンピュータ名").alias("key"),
        "seq",
    )


def allowed_domains(register: DataFrame) -> DataFrame:
    return register.select(F.col("domain").alias("ip"), F.col("Description1").alias("hostName"), "seq")


# Lists of the parameter register, searched in this order after the register.
PROVIDER_LISTS = ["sinet", "hgc", "nmc"]


def network_register(whois: DataFrame, parameters: DataFrame, own_label: str) -> DataFrame:
    """Networks ``User, cidr, seq`` in search order: the register, then the parameter lists.

    A list ``<name>_ip_list`` takes its label from ``<name>_item_name``; the last list, of the
    own networks, has none there and takes ``own_label``.
    """
    entry = parameters.withColumn("list", F.split_part("ID", F.lit("_"), F.lit(1)))
    labels = (
        entry.filter(F.col("ID").isin([f"{name}_item_name" for name in PROVIDER_LISTS[:-1]]))
        .groupBy("list")
        .agg(F.min_by(trim_blanks(F.col("Item")), "seq").alias("label"))
    )
    rank = F.array_position(F.array(*map(F.lit, PROVIDER_LISTS)), F.col("list")).cast("int")
    listed = (
        entry.filter(F.col("ID").isin([f"{name}_ip_list" for name in PROVIDER_LISTS]))
        .join(labels, "list", "left")
        .select(
            F.when(F.col("list") == PROVIDER_LISTS[-1], own_label).otherwise(F.col("label")).alias("User"),
            trim_blanks(F.col("Item")).alias("cidr"),
            F.col("seq").withField("rank", rank).alias("seq"),
        )
    )
    register = whois.select(
        "User", F.col("ip").alias("cidr"), F.col("seq").withField("rank", F.lit(0)).alias("seq")
    )
    return register.unionByName(listed)


def lease_layout(cells: DataFrame) -> DataFrame:
    """Per file the one-based column of its first MAC-like cell, read row by row: ``file, mac_column``."""
    found = cells.select("file", "chunk", "pos", F.posexplode("cells").alias("at", "cell")).filter(has_mac(F.col("cell")))
    first = found.groupBy("file").agg(F.min(F.struct("chunk", "pos", "at")).alias("first"))
    return first.select("file", (F.col("first.at") + 1).alias("mac_column"))


def leases_of_cells(cells: DataFrame, rank: int = 0) -> DataFrame:
    """DHCP leases ``ip, macAddress, hostName, seq`` from ``file, chunk, pos, cells`` rows.

    With MACs in the third column the host is the fourth and a blank one becomes a message;
    with MACs in the second column the host is the first word of the third and a blank one
    becomes null. Files of any other layout give no leases, rows without an address neither.
    """
    def cell(i: int) -> Column:
        return token(F.col("cells"), i)

    third = F.col("mac_column") == 3
    word = token(F.split(cell(3), r"\s+"), 1)
    layouts = lease_layout(cells).filter("mac_column in (2, 3)")
    rows = file_join(cells, layouts).select(
        trim_blanks(cell(1)).alias("ip"),
        F.when(third, cell(3)).otherwise(cell(2)).alias("macAddress"),
        F.when(third, F.when(F.coalesce(cell(4), F.lit("")) == "", BLANK_HOST).otherwise(cell(4)))
        .otherwise(F.when(word != "", word))
        .alias("hostName"),
        sequence(rank, F.col("file"), F.col("chunk"), F.col("pos")).alias("seq"),
    )
    return rows.filter(is_ip(F.col("ip")))


def lease_cells(line: Column) -> Column:
    """Cells of a tab-separated lease line, as many as it has; quotes and carriage returns go."""
    return F.split(F.translate(line, '"\r', ""), "\t", -1)


def read_leases(spark: SparkSession, path: str, rank: int = 0) -> DataFrame:
    """DHCP leases from tab-separated files without header, each in UTF-8 or UTF-16.

    A folder without any lease is an error.
    """
    lines = read_marked_lines(spark, path)
    leases = leases_of_cells(lines.select("file", "chunk", "pos", lease_cells(F.col("line")).alias("cells")), rank)
    if leases.isEmpty():
        raise ValueError(f"no leases in {path}")
    return leases
