"""VPN sessions and VPN-local addresses from log lines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from netaudit.constants import MONTH_ABBREVIATIONS
from netaudit.functions.net import strip_closing_paren
from netaudit.functions.text import token
from netaudit.operators.scan import ordered_scan
from netaudit.session import checkpointed

# Texts that mark the log lines of interest.
SESSION_MARKS = ["connected from", "Call detected from user"]
LOCAL_MARKS = ["PPP/IPCP up"]


def x(position: int) -> Column:
    return token(F.col("words"), position)


def with_any(line: Column, marks: Sequence[str]) -> Column:
    return reduce(Column.__or__, [line.contains(mark) for mark in marks])


def marked_lines(lines: DataFrame) -> DataFrame:
    """Lines that either job below looks at, written out once for both."""
    return checkpointed(lines.filter(with_any(F.col("line"), [*SESSION_MARKS, *LOCAL_MARKS])))


def month_lines(lines: DataFrame, marks: Sequence[str], month: int) -> DataFrame:
    """Lines with any of the marks, split at blanks, of one month (the year is not in the log).

    The month is the first word, so both tests come before the split.
    """
    line = F.col("line")
    of_month = line.rlike(rf"^{MONTH_ABBREVIATIONS[month - 1]}\s")
    return lines.filter(with_any(line, marks) & of_month).select("file", "chunk", "pos", F.split("line", r"\s+", -1).alias("words"))


def vpn_sessions(lines: DataFrame, month: int, chronological: bool = False) -> DataFrame:
    """Distinct ``ip, user`` of VPN connections in a month.

    A line without user takes that of the next line, one step only. Lines follow each other
    by day as text (2 after 10) and then file order; ``chronological`` takes the day as a
    number, then the time of day. The words of the lines are written out once, so that the
    logs are read and split once.
    """
    words = month_lines(lines, SESSION_MARKS, month).select(
        F.lit(month).alias("month"), "file", "chunk", "pos",
        x(2).alias("day"), x(3).alias("time"), (x(7) == "connected").alias("connects"), x(9).alias("ip"), x(10).alias("user"),
    )
    if chronological:
        words = words.select(
            "month", "connects", "ip", "user",
            F.coalesce(F.col("day").try_cast("int"), F.lit(0)).alias("day"),
            F.coalesce("time", F.lit("")).alias("time"), "file", "chunk", "pos",
        )
        levels, order = ["day", "time", "file", "chunk"], "pos"
    else:
        levels, order = ["day", "file", "chunk"], "pos"
        words = words.drop("time")
    ordered = ordered_scan(checkpointed(words), ["month"], levels, order, ahead={"next_user": F.col("user")})
    return ordered.filter("connects").select("ip", F.coalesce("user", "next_user").alias("user")).distinct()


def vpn_local_ips(lines: DataFrame, month: int) -> DataFrame:
    """Distinct addresses handed out inside the VPN."""
    return month_lines(lines, LOCAL_MARKS, month).select(strip_closing_paren(x(11)).alias("ip")).distinct()
