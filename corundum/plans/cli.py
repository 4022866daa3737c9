"""Command line: python -m corundum.plans.cli COMMAND ... Each command is one Spark application; paths may be of any file system."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from corundum.operators import assemble, chemfilter, contract, deliver, energy, stats
from corundum.plans import pipeline
from corundum.schema import BOND, MAIN, PRESETS, XYZ
from corundum.session import materialise
from corundum.sinks import writers
from corundum.sources import batches, sdf


#: Flagged rows that the prefilter shows.
FLAGGED_SHOWN = 15


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="corundum", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)

    def add(name: str, text: str, *paths: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name, help=text)
        for path in paths:
            c.add_argument(path)
        return c

    c = add("validate", "check structure files against the contract; rejected records go to a folder", "input", "rejects")
    c.add_argument("--lenient", action="store_true", help="missing required tags are warnings")
    c = add("split", "structure files to Parquet batches", "input", "output")
    c.add_argument("-b", "--batch-size", type=int, default=5000)
    c = add("curate", "run stages over batches", "input", "output")
    c.add_argument("--stages", nargs="*", default=list(pipeline.STAGES), choices=pipeline.STAGES)
    c.add_argument("--skip", nargs="*", default=[], choices=pipeline.STAGES)
    c.add_argument("--drop-rejected", action="store_true")
    c.add_argument("--threshold", type=float, default=3.5)
    c.add_argument("--preset", choices=sorted(PRESETS), default="neutral_closed_shell")
    c.add_argument("--allowed-elements", nargs="*")
    c.add_argument("--min-heavy", type=int)
    c.add_argument("--max-heavy", type=int)
    c.add_argument("--geometry", action="store_true", help="the filter works out bonds from coordinates and FormalCharge")
    c.add_argument("--compat-rank", action="store_true", help="take canonical ranks for the order of atoms")
    c.add_argument("--order-command", nargs="+", help="external program that orders the atoms of a frame file")
    c.add_argument("--rejects")
    c = add("report", "status counts, funnel, descriptors and similarities of curated batches", "input")
    c.add_argument("--funnel-only", action="store_true")
    c.add_argument("--total", type=int)
    c.add_argument("--rejects", help="table of rejects that a curate run wrote: its counts by stage")
    c.add_argument("--stats", help="statistics table that a stats run wrote")
    c = add("stats", "statistics table of batches: descriptors and similarity", "input", "output")
    c.add_argument("--tanimoto", action="store_true")
    c.add_argument("--every", type=int, default=1, help="ask the similarity of rows divisible by this")
    c.add_argument("--exclude", action="append", default=[], metavar="COLUMN=VALUE")
    c = add("filter-smiles", "chemical filter of a delimited main table by its SMILES", "main", "passed", "rejected")
    c.add_argument("--preset", choices=sorted(PRESETS), default="neutral_closed_shell")
    c.add_argument("--rows", type=int)
    c = add("energy-prefilter", "energy outliers of a delimited main table by the composition of its SMILES", "main", "output", "flagged")
    c.add_argument("--threshold", type=float, default=3.5)
    c.add_argument("--rows", type=int)
    add("convert", "delimited main, atom and bond tables to structure files", "main", "xyz", "bond", "output")
    c = add("frames", "curated batches to training frames", "input", "output")
    c.add_argument("--family", default="QM40")
    c.add_argument("--exclude", action="append", default=[], metavar="COLUMN=VALUE")
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0, or 1 where a record failed a stage that must not reject any."""
    o = _parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("corundum").getOrCreate()
    if o.command == "validate":
        records = sdf.tag_columns(sdf.read_sdf(spark, o.input))
        checked = contract.validate_contract(records, strict=not o.lenient, parsed=F.col("parsed"))
        bad = checked.filter("not passed").select("row_seq", F.concat_ws("; ", "errors").alias("reason"), "record")
        bad.write.mode("overwrite").parquet(o.rejects)
        stats.status_counts(checked, "passed").show()
        return int(bool(checked.filter("not passed").head(1)))
    if o.command in ("filter-smiles", "energy-prefilter", "convert"):
        return _delimited(spark, o)
    if not _any_file(spark, o.input):
        print(f"no batches in {o.input}", file=sys.stderr)
        return 1
    if o.command == "stats":
        df = batches.read_batches(spark, o.input)
        for column, _, value in (x.partition("=") for x in o.exclude):
            df = chemfilter.exclude(df, column, value)
        stats.stats_table(df, o.tanimoto, o.every).write.mode("overwrite").parquet(o.output)
        return 0
    if o.command == "split":
        writers.write_batches(sdf.to_rows(sdf.read_sdf(spark, o.input)).drop("tags"), o.output, o.batch_size)
        return 0
    if o.command == "report":
        df = spark.read.parquet(o.input)
        pipeline.funnel_report(df, o.total).show(50, False)
        if not o.funnel_only:
            pipeline.stage_report(df).show(50, False)
            stats.describe(df, [c for c in ("num_atoms", "Energy_Ha") if c in df.columns]).show()
            stats.range_buckets(df, "num_atoms").show()
        if o.rejects:
            pipeline.reject_counts(spark.read.parquet(o.rejects)).show(50, False)
        if o.stats:
            table = spark.read.parquet(o.stats)
            stats.descriptor_report(table).show(50, False)
            stats.tanimoto_report(table).show(50, False)
        return 0
    if o.command == "frames":
        df = batches.read_batches(spark, o.input)
        for column, _, value in (x.partition("=") for x in o.exclude):
            df = df.filter(~F.col(column).eqNullSafe(value))
        writers.write_frames(df, o.output, o.family)
        return 0
    heavy = None if o.min_heavy is None and o.max_heavy is None else (o.min_heavy or 0, 999 if o.max_heavy is None else o.max_heavy)
    options = pipeline.Options(
        stages=tuple(s for s in o.stages if s not in o.skip), on_reject="drop" if o.drop_rejected else "tag", threshold=o.threshold, preset=o.preset,
        elements=tuple(o.allowed_elements) if o.allowed_elements else None, heavy=heavy, geometry=o.geometry,
        compat_rank=o.compat_rank, order_command=tuple(o.order_command) if o.order_command else None,
    )
    base = batches.read_batches(spark, o.input)
    base = base.drop(*[f"{s}_status" for s in pipeline.STAGES], "filter_reason", "dedup_reason", "validate_errors", "ICONF", "CanonicalSMILES", "CompoundID")
    writers.write_batches(pipeline.curate(base, options), o.output)
    done = spark.read.parquet(o.output)
    if o.rejects:
        pipeline.rejects_by_stage(done).write.mode("overwrite").parquet(o.rejects)
    pipeline.stage_report(done, options.stages).show(50, False)
    if "validate" in options.stages:
        for r in pipeline.still_rejected(done).collect():
            print(f"warning: {r['rows']} rows that the stage {r['stage']} turned down are still there", file=sys.stderr)
    if "energy" in options.stages and pipeline.nothing_to_fit(done):
        print("no record to fit energies to", file=sys.stderr)
        return 1
    return int(pipeline.failed(done))


def _any_file(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop)
    if not found:
        return False
    return bool(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).inputFiles())


def _delimited(spark: SparkSession, o: argparse.Namespace) -> int:
    """The commands over delimited tables of molecules."""
    head = spark.read.csv(o.main, header=True).columns
    main = batches.read_csv(spark, o.main, StructType([f for f in MAIN.fields if f.name in head] + [StructField(c, StringType()) for c in head if c not in MAIN.names]), getattr(o, "rows", None), head)
    if o.command == "filter-smiles":
        done = materialise(chemfilter.filter_smiles(main, "smile", o.preset))
        writers.write_csv(done.filter("filter_status = 'ok'").select(*[F.col(f"`{c}`") for c in head]), o.passed)
        writers.write_csv(done.filter("filter_status <> 'ok'").select("Zinc_id", "smile", F.col("filter_reason").alias("reason")), o.rejected)
        chemfilter.reason_counts(done).show(50, False)
        return 0
    if o.command == "energy-prefilter":
        done = materialise(energy.smiles_prefilter(main, threshold=o.threshold))
        writers.write_csv(done.select(*[F.col(f"`{c}`") for c in head if c != "energy_status"], "energy_status"), o.output)
        if "Internal_E(0K)" in head:
            flagged = energy.flagged_rows(done)
            flagged.show(FLAGGED_SHOWN, False)
            writers.write_csv(flagged, o.flagged)
        stats.status_counts(done, "energy_status").show()
        return 0
    xyz, bond = (batches.with_file_order(batches.read_csv(spark, p, s), n) for p, s, n in ((o.xyz, XYZ, "xyz_seq"), (o.bond, BOND, "bond_seq")))
    built = assemble.assemble(main, xyz, bond)
    block = deliver.build_block(F.col("SourceID"), F.col("symbols"), F.col("coordinates"), F.col("bonds"))
    records = materialise(built.select(deliver.sdf_record(block, assemble.record_tags()).alias("value"), deliver.block_refusal(F.col("symbols"), F.col("coordinates"), F.col("bonds")).alias("why"), "SourceID"))
    writers.write_records(records.filter("value is not null").select("value"), o.output)
    refused = records.filter("value is null").groupBy("why").agg(F.count(F.lit(1)).alias("rows"))
    refused.show(50, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
