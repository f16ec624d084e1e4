"""Resumable ingest: the four source queries, loaded chunk by chunk with a ledger.

``python -m pushback.plans.ingest --sources parquet:FOLDER --out DIR --start ... --end ...``

A long history is loaded in half-open time chunks.  Every chunk is a folder of
its own, ``DIR/<table>/chunk=<start>``, and is always written as a whole, so
loading it again replaces it.  After a chunk is written its entry goes to the
ledger (``DIR/_ledger/<table>/chunk=<start>``) with its bounds, settings and row
count.  A run that was killed is simply started again: chunks with an entry of
the same settings are left alone, all others are loaded; what a killed run left
without an entry is not read and is replaced.

A source row belongs to one chunk, that of the first of its times inside the
window, so the chunks together are exactly the query over the whole window.
"""

from __future__ import annotations

import argparse
import json
import logging
from dataclasses import asdict, dataclass, replace
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pushback.plans import jobs
from pushback.plans.config import PipelineParams
from pushback.sources import flight_tables as ft
from pushback.sources import readers

log = logging.getLogger(__name__)

#: Times by which a source row can qualify for the window, in order.
FLIGHT_TIMES = ("departure_runway_actual_time", "arrival_stand_actual_time", "arrival_runway_actual_time",
                "arrival_movement_area_actual_time")
RUNWAY_TIMES = ("departure_runway_actual_time", "arrival_runway_actual_time")
ESTIMATE_TIMES = ("departure_runway_actual_time", "arrival_stand_actual_time")
LEDGER = "table string, chunk string, lo string, hi string, settings string, rows long"


@dataclass
class Chunk:
    name: str       # start of the chunk, as a folder name
    lo: str
    hi: str         # exclusive
    predicate: str  # the source rows that belong to it


def chunks(times: Sequence[str], start: str, end: str, days: int) -> list[Chunk]:
    predicates = readers.chunk_predicates(times, start, end, days)
    return [Chunk(lo[:19].replace(" ", "T").replace(":", ""), lo, hi, p.replace("TIMESTAMP '", "TIMESTAMP_NTZ '"))
            for (lo, hi), p in zip(readers.time_chunks(start, end, days), predicates)]


def ledger(spark: SparkSession, out: str, table: str) -> DataFrame:
    """Entries of the loaded chunks."""
    schema = spark.createDataFrame([], LEDGER).schema
    return readers.read_or_empty(spark, f"{out}/_ledger/{table}/*", schema)


def load(spark: SparkSession, out: str, table: str, parts: Sequence[Chunk], settings: str,
         read: Callable[[Chunk], DataFrame], force: bool = False) -> list[str]:
    """Load the chunks that the ledger does not have with these bounds and settings; returns their names."""
    done = set() if force else {(r["chunk"], r["lo"], r["hi"], r["settings"]) for r in ledger(spark, out, table).collect()}  # a row a chunk
    loaded = []
    for c in parts:
        if (c.name, c.lo, c.hi, settings) in done:
            continue
        path, entry = f"{out}/{table}/chunk={c.name}", f"{out}/_ledger/{table}/chunk={c.name}"
        # no entry while the chunk is being replaced
        spark.createDataFrame([], LEDGER).coalesce(1).write.mode("overwrite").parquet(entry)
        read(c).write.mode("overwrite").parquet(path)
        rows = spark.read.parquet(path).count()
        spark.createDataFrame([(table, c.name, c.lo, c.hi, settings, rows)], LEDGER).coalesce(1).write.mode("overwrite").parquet(entry)
        log.info("%s: chunk %s, %d rows", table, c.name, rows)
        loaded.append(c.name)
    return loaded


def loaded_table(spark: SparkSession, out: str, table: str) -> DataFrame:
    """All chunks that the ledger has; an error when there is none."""
    names = sorted(r["chunk"] for r in ledger(spark, out, table).select("chunk").collect())  # a row a chunk
    if not names:
        raise ValueError(f"{out}: no chunk of {table} is loaded")
    return spark.read.parquet(*[f"{out}/{table}/chunk={n}" for n in names])


def _fractions(src: jobs.RawSources, c: Chunk, p: PipelineParams) -> DataFrame:
    """Speed fractions of the chunk's flights, from the positions since the first of them entered the movement area."""
    flights = src.flights.where(c.predicate)
    first = flights.agg(F.min(F.least("departure_movement_area_actual_time", "departure_runway_actual_time"))).first()[0]
    lo = F.lit(first if first is not None else c.lo).cast("timestamp_ntz")
    near = src.positions.where((F.col("timestamp") >= lo) & (F.col("timestamp") < F.lit(c.hi).cast("timestamp_ntz")))
    return ft.speed_fraction(near, flights, p.window, p.speed_threshold_knots)


TABLES = {
    "flights": (FLIGHT_TIMES, lambda s, c, p: ft.flight_summary(s.flights.where(c.predicate), p.window)),
    "runways": (RUNWAY_TIMES, lambda s, c, p: ft.runway_actuals(s.runways.where(c.predicate), p.window)),
    "fractions": (FLIGHT_TIMES[:1], _fractions),
    "estimates": (ESTIMATE_TIMES, lambda s, c, p: ft.external_estimates(s.estimates.where(c.predicate), p.window)),
}


def run(spark: SparkSession, src: jobs.RawSources, out: str, p: PipelineParams, chunk_days: int = 30, position_chunk_days: int = 5,
        tables: Sequence[str] = tuple(TABLES), force: bool = False) -> dict[str, list[str]]:
    """Load the tables that are not loaded yet; returns the chunks written per table."""
    out = out.rstrip("/")
    settings = json.dumps({**asdict(p.window), "speed": p.speed_threshold_knots}, sort_keys=True)
    done = {}
    for name in tables:
        times, query = TABLES[name]
        days = position_chunk_days if name == "fractions" else chunk_days
        parts = chunks(times, p.window.start, p.window.end, days)
        done[name] = load(spark, out, name, parts, settings, lambda c, q=query: q(src, c, p), force)
    return done


def ingested(spark: SparkSession, out: str) -> jobs.Ingested:
    """The loaded tables, as the pipelines take them."""
    return jobs.Ingested(*(loaded_table(spark, out.rstrip("/"), name) for name in ("flights", "runways", "fractions", "estimates")))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sources", required=True, help="parquet:<folder> or adapter:<driver table folder>")
    ap.add_argument("--out", required=True)
    ap.add_argument("--airports", default=None, help="comma-separated ICAO codes")
    ap.add_argument("--start", default=None)
    ap.add_argument("--end", default=None)
    ap.add_argument("--chunk-days", type=int, default=30)
    ap.add_argument("--position-chunk-days", type=int, default=5)
    ap.add_argument("--tables", default=",".join(TABLES))
    ap.add_argument("--force", action="store_true", help="load chunks again that the ledger has")
    a = ap.parse_args(argv)
    from pushback.session import local_session, tune
    spark = tune(SparkSession.getActiveSession() or local_session())
    window = {k: v for k, v in (("start", a.start), ("end", a.end)) if v}
    if a.airports:
        window["airports"] = tuple(a.airports.split(","))
    p = PipelineParams()
    p = replace(p, window=replace(p.window, **window))
    print(json.dumps(run(spark, jobs.sources_of(spark, a.sources), a.out, p, a.chunk_days, a.position_chunk_days, a.tables.split(","), a.force)))


if __name__ == "__main__":
    main()
