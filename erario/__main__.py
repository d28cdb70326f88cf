"""Command line of the engine: ``python -m erario COMMAND …``, one command for each scheduled run."""

from __future__ import annotations

import argparse
import json
import re
import sys
from collections.abc import Sequence
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from erario.ml import jobs
from erario.operators import quality
from erario.operators.lake import Lake
from erario.plans import composed, gold, maintenance, report, silver
from erario.session import build_session, ship_package
from erario.sources import batches, paged
from erario.streaming import incremental


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="erario", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *options: str, **defaults: str) -> argparse.ArgumentParser:
        c = sub.add_parser(name, help=text)
        for o in options:
            c.add_argument(f"--{o}", required=True)
        for o, d in defaults.items():
            c.add_argument(f"--{o}", default=d)
        return c

    add("ingest", "read a paged source into a raw batch", "url", "root", "source", lake="", date=date.today().isoformat(), day="")
    add("validate", "check the raw batches of a date", "root", "date")
    add("silver", "conform and merge the raw batches of a date", "root", "lake", "date")
    add("counts", "keep the record counts of a date", "lake", "date", "counts")
    add("gold", "rebuild the stored tables", "data", "lake", select="")
    add("quality", "run the data tests and keep the warnings", "data", "lake")
    add("anomaly", "train, score and store anomaly scores", "data", "lake", "bundle", trees="400")
    add("forecast", "tune and store payment forecasts", "data", "lake", "bundle")
    add("report", "write the narrative report from a text file of the writer", "data", "text", "out")
    c = add("maintenance", "compact, retain and expire stored tables", "lake")
    c.add_argument("--table", action="append", default=[], help="name[:slice_by[:stamp:days]]; all tables where none is given")
    return p


def _upkeep(lake: Lake, tables: Sequence[str]) -> list[maintenance.Upkeep]:
    out = []
    for t in tables or lake.tables():
        name, slice_by, stamp, days = (*t.split(":"), "", "", "")[:4]
        out.append(maintenance.Upkeep(name, 1, slice_by or None, stamp or None, int(days) if days else None))
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run one command; prints its result as JSON. Returns 1 where data tests or a batch fail, else 0."""
    a = _parser().parse_args(argv)
    spark = spark or build_session()
    ship_package(spark)
    lake = Lake(spark, a.lake) if getattr(a, "lake", "") else None
    try:
        said = _run(a, spark, lake)
    except (quality.FailedCheck, quality.InvalidBatch) as e:
        print(json.dumps({"erro": str(e)}, ensure_ascii=False))
        return 1
    print(json.dumps(said, ensure_ascii=False, default=str))
    return 0


def _run(a: argparse.Namespace, spark: SparkSession, lake: Lake | None) -> object:
    if a.command == "ingest":
        spark.dataSource.register(paged.PagedSource)
        raw = spark.read.format("erario_paged").option("url", a.url).load()
        pages = raw.agg(F.max("pagina").alias("n")).first()["n"] or 0
        # the union of the records' types, over all of them; what is null or of several types everywhere is read as text
        found = raw.agg(F.schema_of_variant_agg(F.try_parse_json("registro")).alias("t")).first()["t"]
        schema = re.sub(r"\b(VOID|VARIANT)\b", "STRING", (found or "").replace("OBJECT<", "STRUCT<"))
        rows = raw.select(F.from_json("registro", schema).alias("r")).select("r.*") if pages else raw.select("registro").limit(0)
        batches.write_batch(rows, a.root, a.source, a.date, F.col(a.day) if a.day and a.day in rows.columns else None)
        said = batches.extract_summary(rows, a.day, pages) if a.day and a.day in rows.columns else {"registros": rows.count(), "paginas": pages}
        if lake is not None and said.get("data_maxima"):
            said["marca"] = incremental.advance(lake, a.source, said["data_maxima"])
        return said
    if a.command == "validate":
        return silver.validate(spark, a.root, a.date)
    if a.command == "silver":
        return silver.run(spark, lake, a.root, a.date)
    if a.command == "counts":
        return silver.record_counts(lake, a.date, json.loads(a.counts))
    if a.command == "gold":
        return gold.build(spark, a.data, lake, None, a.select.split(",") if a.select else None)
    if a.command == "quality":
        checks = composed.checks(spark, a.data)
        lake.append("audit.avisos", quality.warning_history(checks, F.current_timestamp()))
        return quality.enforce(checks)
    if a.command == "anomaly":
        return jobs.run_anomaly(spark, lake, composed.op_features(spark, a.data), a.bundle, int(a.trees))
    if a.command == "forecast":
        return jobs.run_forecast(spark, lake, composed.op_panel(spark, a.data), a.bundle)
    if a.command == "report":
        with open(a.text, encoding="utf-8") as f:
            text = f.read()
        r = report.run(spark, a.data, lambda _: text)
        report.save(r, a.out)
        return {"sem_apoio": r.unsupported}
    return maintenance.run(lake, _upkeep(lake, a.table))


if __name__ == "__main__":
    sys.exit(main())
