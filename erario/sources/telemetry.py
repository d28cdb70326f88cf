"""Readers of operational text: container statistics, disk usage, login journals and audit trails.

All work on a DataFrame with a column ``value`` (a line, or a block for audit trails), so that batch reads and streams
(``readStream.text``) share them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from erario.functions import rules

#: Least size of a file system that is reported.
LEAST_DISK = 1_000_000_000
#: Separator of the blocks of an audit trail.
BLOCKS = "----"


def container_stats(lines: DataFrame) -> DataFrame:
    """(container, cpu_percent, mem_usage_bytes, mem_limit_bytes, mem_percent) of JSON lines; other lines give nothing."""
    j = lines.select(F.from_json("value", "Name string, CPUPerc string, MemUsage string, MemPerc string").alias("j")).select("j.*").filter("Name is not null")
    part = F.split("MemUsage", "/")
    return j.select(F.col("Name").alias("container"), rules.percent(F.col("CPUPerc")).alias("cpu_percent"), rules.size_bytes(F.trim(F.get(part, 0))).alias("mem_usage_bytes"), rules.size_bytes(F.trim(F.get(part, 1))).alias("mem_limit_bytes"), rules.percent(F.col("MemPerc")).alias("mem_percent"))


def disk_usage(lines: DataFrame) -> DataFrame:
    """(ponto, total_bytes, usado_bytes, percentual) of lines of exactly four parts; small file systems are left out."""
    p = lines.select(F.split(F.trim("value"), r"\s+").alias("p")).filter(F.size("p") == 4)
    d = p.select(F.get("p", 0).alias("ponto"), F.get("p", 1).try_cast("bigint").alias("total_bytes"), F.get("p", 2).try_cast("bigint").alias("usado_bytes"), F.regexp_replace(F.get("p", 3), "%", "").try_cast("double").alias("percentual"))
    return d.filter((F.col("total_bytes") >= LEAST_DISK) & F.col("usado_bytes").isNotNull() & F.col("percentual").isNotNull())


_STAMP = r"^(\S+) \S+ sshd\S*\[(\d+)\]: "
_LOGIN = _STAMP + r"Accepted \S+ for (\S+) from (\S+) port"
_LOGOUT = _STAMP + r"pam_unix\(sshd:session\): session closed for user (\S+)"


def ssh_sessions(lines: DataFrame, since: str | None = None) -> DataFrame:
    """(evento, usuario, origem_ip, sessao_pid, timestamp_evento) of a journal; other lines give nothing.

    Logouts have no address. ``since``: only events at or after that ISO time.
    """
    v = F.col("value")
    kind = F.when(v.rlike(_LOGIN), "login").when(v.rlike(_LOGOUT), "logout")
    e = lines.select(kind.alias("evento"), F.when(kind == "login", F.regexp_extract(v, _LOGIN, 3)).otherwise(F.regexp_extract(v, _LOGOUT, 3)).alias("usuario"), F.when(kind == "login", F.regexp_extract(v, _LOGIN, 4)).alias("origem_ip"), F.regexp_extract(v, _STAMP, 2).alias("sessao_pid"), F.try_to_timestamp(F.regexp_extract(v, r"^(\S+)", 1)).alias("timestamp_evento"))
    e = e.filter("evento is not null")
    return e.filter(F.col("timestamp_evento") >= F.lit(since).cast("timestamp")) if since else e


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of an audit trail file as rows ``value``."""
    return spark.read.option("lineSep", BLOCKS).text(path)


def audit_commands(blocks: DataFrame) -> DataFrame:
    """(timestamp_evento, usuario, executado_como, comando) of blocks; those without a login user are left out.

    The command is the title of the process, or its short name where the title is missing. Users are told by auid and
    uid; an auid that is unset belongs to no session.
    """
    v = F.col("value")
    field = lambda name: F.regexp_extract(v, rf"(?:^|\s){name}=\"?([^\s\"]+)\"?", 1)
    title = F.trim(F.regexp_extract(v, r"proctitle=([^\n]+)", 1))
    when = rules.audit_time(F.regexp_extract(v, r"msg=audit\((\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}\.\d{3})", 1))
    rows = blocks.select(when.alias("timestamp_evento"), field("auid").alias("usuario"), field("uid").alias("executado_como"), F.when(title != "", title).otherwise(field("comm")).alias("comando"))
    return rows.filter("usuario <> '' and usuario not in ('unset', '4294967295') and timestamp_evento <> ''")
