"""Runs of a whole country: lots that resume, the gate before publication, reruns of what is invalid, and the command line."""

from __future__ import annotations

import argparse
import json
import math
import sys
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gazetta.operators import delivery, quality, scope
from gazetta.scratch import clear_scratch
from gazetta.sources.tables import config_table, exists, listed, observed_write, read_any, remove, write_manifest, write_report, write_tables

Tables = dict[str, DataFrame]
LOT_TABLES = ("data", "targets", "pending", "sources", "texts")
#: Partitions that a table of lots gets in one run, about; beyond it lots share them.
MOST_PARTITIONS = 64


def lots(targets: DataFrame, chunk_size: int = 0) -> DataFrame:
    """Targets with their lot: the state and, with ``chunk_size``, a number from 1 within it, of three digits or as many as it takes."""
    chunked = quality.chunks(targets, ["state"], ["ordinal", "target"], chunk_size) if chunk_size else targets.withColumn("chunk", F.lit(1).cast("long"))
    number = F.col("chunk").cast("string")
    return chunked.withColumn("lot", F.concat_ws("-", F.upper("state"), F.lpad(number, F.greatest(F.lit(3), F.length(number)), "0")))


def _names(df: DataFrame, col: str = "lot") -> list[str]:
    """The lots of a table, in order; the driver holds their names, and nothing else of them."""
    return [r[0] for r in df.select(col).distinct().orderBy(col).collect()]


def _partitions(spark: SparkSession, path: str) -> DataFrame | None:
    """A table of lots, whatever columns each has; None where no lot has a row."""
    if not exists(spark, f"{path}/lot=*/*.parquet"):
        return None
    return spark.read.option("mergeSchema", True).parquet(path).drop("lot")


def _current(spark: SparkSession, folder: str) -> DataFrame | None:
    """The last mark of each lot: the partition and the run in which its rows are, and the schemas of its tables. None without marks."""
    marks = _partitions(spark, f"{folder}/marks")
    return None if marks is None else marks.groupBy("_lot").agg(F.max("_run").alias("_run"), F.max_by("_part", "_run").alias("_part"), F.max_by("schemas", "_run").alias("schemas"))


def _few(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """Names of lots as a table, to be joined with instead of a long condition."""
    return F.broadcast(spark.createDataFrame([(n,) for n in names], "_lot string"))


def lots_done(spark: SparkSession, folder: str) -> list[str]:
    """The lots that were written to the end: each has a mark, which is written after all of its tables."""
    marks = _current(spark, folder)
    return _names(marks, "_lot") if marks is not None else []


def lot_done(spark: SparkSession, folder: str, lot: str) -> bool:
    return lot in lots_done(spark, folder)


def lay_out_pages(pages: DataFrame, placed: DataFrame, folder: str) -> DataFrame:
    """Pages written in one partition a lot, by the target that they were recorded for: who reads one lot reads its partition alone.

    ``placed``: targets with their lot. Partitions that are there are replaced where ``pages`` brings pages of theirs, and stay otherwise.
    """
    put = pages.join(placed.select("target", "lot").distinct(), "target").repartition("lot", F.pmod(F.xxhash64("page_id"), F.lit(16)))
    put.write.mode("overwrite").partitionBy("lot").option("partitionOverwriteMode", "dynamic").parquet(folder)
    return pages.sparkSession.read.parquet(folder)


def _clear(spark: SparkSession, folder: str, own: Sequence[str], parts: set[str]) -> None:
    """Delete the partitions that hold no lot but those of ``own``, marks first: those about to be written (``parts``) and those where the lots were before."""
    marks, kept = _current(spark, folder), set()
    if marks is not None:
        kept = set(_names(marks.join(_few(spark, own), "_lot", "left_anti"), "_part"))
        parts = parts | set(_names(marks.join(_few(spark, own), "_lot", "left_semi"), "_part"))
    for name in ("marks", *LOT_TABLES):
        remove(spark, [path for path in listed(spark, f"{folder}/{name}/lot=*") if unquote(path.rpartition("/lot=")[2]) in parts - kept])


def run_lots(targets: DataFrame, work: Callable[[DataFrame], Tables], folder: str, chunk_size: int = 0, force: bool = False, at_once: int | None = None) -> list[str]:
    """Run ``work`` on the targets of all lots that aren't done, in one plan, and write its tables in one partition a lot; returns the lots that were run.

    ``work`` gets the targets with their ``lot`` and reads what it reads once, however many lots are open; its tables need a ``target`` or a ``lot``.
    Beyond ``MOST_PARTITIONS`` lots neighbours share a partition, so that files don't become many and tiny. Rows carry their lot and their run, and a lot's rows are
    those of the run that its last mark names. The partitions of the lots that run are cleared first, where no other lot has rows in them, and marked as done last, so that a run that
    was killed is taken up where it stood, a rerun of one lot touches no file of another, and other lots stay as they are; a lot of a shared partition that is run by itself gets one of its own, and
    its old rows count until its new mark is there. ``at_once``: so many lots in one plan and under one set of marks, where a run is to be taken up in steps.
    """
    spark = targets.sparkSession
    placed = lots(targets, chunk_size).drop("chunk")
    done = set() if force else set(lots_done(spark, folder))
    names = [n for n in _names(placed) if n not in done]
    step, width = at_once or max(1, len(names)), math.ceil(len(names) / MOST_PARTITIONS)
    for own in (names[i : i + step] for i in range(0, len(names), step)):
        groups = [own[i : i + width] for i in range(0, len(own), width)]
        part_of = {lot: lot if len(g) == 1 else f"{g[0]}..{g[-1]}" for g in groups for lot in g}
        _clear(spark, folder, own, set(part_of.values()))
        marks = _current(spark, folder)
        last = marks.agg(F.max("_run")).first()[0] if marks is not None else "0"
        run = f"{int(last.partition('-')[0]) + 1:09d}-{uuid.uuid4().hex}"
        parts = F.broadcast(spark.createDataFrame(list(part_of.items()), "lot string, _part string"))
        some = placed.join(parts.select("lot"), "lot", "left_semi").select(*placed.columns)
        where = some.select("target", "lot").distinct()
        tables = {n: df if "lot" in df.columns else df.join(where, "target") for n, df in work(some).items()}
        schemas = F.create_map(*(F.lit(x) for n, df in tables.items() for x in (n, df.drop("lot").schema.json()))).cast("map<string, string>")
        for name, df in [*((n, df.join(parts, "lot")) for n, df in tables.items()), ("marks", parts.withColumn("schemas", schemas))]:
            rows = df.withColumnRenamed("lot", "_lot").withColumns({"_run": F.lit(run), "lot": F.col("_part")})
            rows.hint("rebalance", "lot").write.mode("append").partitionBy("lot").parquet(f"{folder}/{name}")
    return names


def consolidate(spark: SparkSession, folder: str, lots_wanted: Sequence[str], only: str | None = None) -> Tables:
    """The tables of the lots together, whatever columns each has; ``only`` keeps one sphere.

    A table of which no lot has a row is empty, with the columns that the marks tell; one that no lot knows is absent.
    """
    marks, out = _current(spark, folder), {}
    if marks is None:
        return out
    wanted = marks.join(_few(spark, lots_wanted), "_lot", "left_semi")
    known = dict(wanted.select(F.explode("schemas")).distinct().collect())
    for name in (n for n in LOT_TABLES if n in known):
        df = _partitions(spark, f"{folder}/{name}")
        df = spark.createDataFrame([], StructType.fromJson(json.loads(known[name]))) if df is None else df.join(wanted.select("_lot", "_run"), ["_lot", "_run"], "left_semi").drop("_lot", "_run", "_part")
        out[name] = scope.sphere(df, only) if only else df
    return out


def deliver(tables: Tables, pages: DataFrame, folder: str, sample: int = 80, seed: int = 42) -> tuple[int, list[str]]:
    """Audit, verify and, if both are clean, publish. Returns the exit code and what is in the way.

    Reports are written in any case, and the pass that writes one counts what is in it; ``pages``: url, text, status of the sources.
    """
    found = observed_write(tables["audit"], f"{folder}/audit")["rows"]
    verified = quality.verify_records(quality.verification_sample(tables["data"], sample, seed), pages)
    bad = observed_write(verified.drop("ordinal"), f"{folder}/verification", differing=F.count_if(F.col("verdict") != "Validado"))["differing"]
    problems = [name for name, n in (("audit", found), ("verification", bad)) if n]
    if not problems:
        write_tables({n: df.drop("ordinal") for n, df in tables.items() if n not in ("audit", "texts")}, f"{folder}/published")
    return int(bool(problems)), problems


def reprocess(targets: DataFrame, data: DataFrame, work: Callable[[DataFrame], Tables], folder: str) -> DataFrame:
    """Run the targets with invalid rows again and put their new rows in the place of the old ones; manifests say what was invalid and what ran."""
    keys = ["state", "target", "sphere"]
    invalid = delivery.invalid_rows(data, [*keys, "role", "status", "name", "source_url"])
    again = delivery.to_rerun(targets, invalid, keys)
    write_manifest({"invalid_rows": invalid, "jobs": again.select(*keys)}, f"{folder}/manifest")
    fresh = work(again)["data"]
    kept = data.join(again.select(*keys).distinct(), keys, "left_anti")
    write_manifest({"failed": again.select(*keys).join(fresh.select(*keys).distinct(), keys, "left_anti")}, f"{folder}/manifest")
    return kept.unionByName(fresh, allowMissingColumns=True)


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="gazetta", description="Build an audited contact directory from targets and recorded pages.")
    p.add_argument("--targets", help="list of targets; the usual places are tried without it")
    p.add_argument("--pages", required=True, help="Parquet of recorded pages: page_id, target, url, html")
    p.add_argument("--output", required=True, help="folder for the tables")
    p.add_argument("--state", help="one state only")
    p.add_argument("--target", help="one target only, accents aside")
    p.add_argument("--limit", type=int, help="so many targets")
    p.add_argument("--sphere", choices=["municipal", "estadual"], help="targets of one sphere only")
    p.add_argument("--governments", help="JSON or Parquet of state governments: state, government, site, organs (name, site, categories)")
    p.add_argument("--overrides", help="table of known contacts: state, name, sphere, and the columns of a record, the person as person")
    p.add_argument("--rules", help="table of rules on addresses, names and sources: kind, pattern")
    p.add_argument("--rules-only", action="store_true", help="the table's kinds of rules in place of the library's own, not beside them")
    p.add_argument("--live", help="table of addresses that are up (url, ok): targets without a site get the first of theirs that is")
    p.add_argument("--collected-on", default="", help="date that the rows carry")
    p.add_argument("--chunk-size", type=int, default=0, help="targets a lot within a state")
    p.add_argument("--lots-at-once", type=int, help="lots in one plan; all that are open without it")
    p.add_argument("--layout", action="store_true", help="lay the pages out by lot first, so that reruns read their lots only")
    p.add_argument("--force", action="store_true", help="run lots again that are done")
    p.add_argument("--verify", type=int, help="verify so many rows (0: all) and publish only what passes")
    p.add_argument("--filter-only", action="store_true", help="write the targets in scope and stop")
    p.add_argument("--dry-run", action="store_true", help="show the targets and stop")
    return p.parse_args(argv)


def chosen_targets(spark: SparkSession, args: argparse.Namespace, places: DataFrame, inside: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The targets of a run, municipal ones and then those of the states that occur, and the governments' configuration, if one was given."""
    from gazetta.operators.records import all_targets, municipal_targets

    if args.live:
        sites = scope.resolve_sites(inside.withColumn("id", F.col("ordinal")), read_any(spark, args.live))
        inside = sites.drop("id", "site_notes", "site_status")
    targets, config = municipal_targets(inside), None
    if args.governments:
        config = read_any(spark, args.governments)
        last = F.lit(1 << 62)
        state = scope.state_targets(inside.select(F.upper("state").alias("state")), config.withColumn("state", F.upper("state")))
        state = state.withColumns({"target": F.col("name"), "municipality": F.col("name"), "ordinal": last}).drop("name")
        if args.target:
            state = state.where("false")
        targets = all_targets(targets, state)
    return (scope.sphere(targets, args.sphere) if args.sphere else targets), config


def main(argv: Sequence[str] | None = None) -> int:
    """``python -m gazetta.operators.batch``: scope, filters, targets of both spheres, lots, consolidation, audit, and with ``--verify`` the gate.

    The exit code is 1 where the audit has issues or, with ``--verify``, a row differs from its source.
    """
    from gazetta.operators.rules import read_rules
    from gazetta.plans.directory import build
    from gazetta.sources.tables import read_targets, resolve_input, write_list

    args = arguments(argv)
    spark = SparkSession.builder.appName("gazetta").getOrCreate()
    places = read_targets(spark, resolve_input(spark, args.targets)).withColumn("ordinal", F.monotonically_increasing_id())
    inside = scope.choose(scope.scope_filter(places, scope.limits(spark)), args.state, args.target, args.limit)
    write_list(inside.drop("ordinal"), f"{args.output}/scope")
    if args.filter_only:
        return 0
    targets, config = chosen_targets(spark, args, places, inside)
    if args.dry_run:
        targets.select("state", "target", "sphere", "site").show(1000, False)
        return 0
    folder = f"{args.output}/lots"
    pages = spark.read.parquet(args.pages)
    if args.layout:
        pages = lay_out_pages(pages, lots(targets, args.chunk_size), f"{args.output}/pages")
    rules = read_rules(spark, args.rules, not args.rules_only) if args.rules else None
    known = read_any(spark, args.overrides) if args.overrides else None

    def work(some: DataFrame) -> Tables:
        own = pages.where(F.col("lot").isin(_names(some))).drop("lot") if args.layout else pages
        tables = build(some.drop("ordinal", "lot"), own.join(some.select("target").distinct(), "target", "left_semi"), args.collected_on, known, rules=rules)
        return {n: tables[n] for n in LOT_TABLES}

    run_lots(targets, work, folder, args.chunk_size, args.force, args.lots_at_once)
    names = _names(lots(targets, args.chunk_size))
    tables = consolidate(spark, folder, names)
    texts = tables.pop("texts")
    tables |= {"consolidated": tables["data"], "summary": quality.summary(tables["data"], tables["targets"], tables["pending"], args.collected_on), "configuration": config_table(spark, {"run": vars(args)})}
    whole = not (args.state or args.target or args.limit or args.sphere)
    issues = quality.audit(tables, ["state", "target", "sphere", "ordinal"], quality.expected_municipal(places, scope.limits(spark)) if whole else None, expected_of(config, inside) if whole and config is not None else None)
    write_tables({n: df.drop("ordinal") for n, df in tables.items()}, f"{args.output}/tables")
    if args.verify is None:
        return write_report(issues, f"{args.output}/audit")
    code, problems = deliver(tables | {"audit": issues}, texts.select(F.col("final_url").alias("url"), "text", "status"), f"{args.output}/delivery", args.verify)
    if problems:
        print("not published:", ", ".join(problems), file=sys.stderr)
    return code


def expected_of(config: DataFrame, inside: DataFrame) -> DataFrame:
    """The configured targets of the states that occur."""
    present = inside.select(F.upper("state").alias("state")).distinct()
    return quality.expected_state(config.withColumn("state", F.upper("state")).join(present, "state", "left_semi"))


if __name__ == "__main__":
    code = main()
    clear_scratch(SparkSession.active())
    sys.exit(code)
