"""The curation pipeline: stages as DataFrame transformations in one application, no files between them.

The blocks are read once: one Arrow function works out all that the stages need of a record, and a narrow table of these
facts is written. Fit, first occurrences and mirror images run over the narrow table; its statuses are joined to the
wide records once, in the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corundum.functions.arrow import external_order, reorder_block, reorder_block_by_rank
from corundum.operators import chemfilter, dedup, energy, integrity, stats, stereo
from corundum.session import materialise, spread

STAGES = ("energy", "filter", "dedup", "validate", "stereo", "reorder")
#: Rows that a stage turns down.
REJECTED = {
    "energy": "energy_status <> 'ok'", "filter": "filter_status <> 'ok'", "dedup": "dedup_status <> 'ok'",
    "validate": "validate_status <> 'ok'", "stereo": "stereo_status = 'removed_enantiomer'", "reorder": "reorder_status <> 'ok'",
}


@dataclass(frozen=True)
class Options:
    """on_reject: `tag` keeps every row with its statuses, `drop` passes on only what a stage takes.

    geometry: the filter works out bonds and charges from coordinates and FormalCharge.
    compat_rank: canonical ranks are taken for the order of atoms. order_command: an external program orders the atoms,
    see external_order; only curate runs it, and a record that it fails on keeps its block with reorder_status `failed`.
    """

    stages: tuple[str, ...] = STAGES
    on_reject: str = "tag"
    threshold: float = energy.THRESHOLD
    preset: str = "neutral_closed_shell"
    elements: tuple[str, ...] | None = None
    heavy: tuple[int, int] | None = None
    geometry: bool = False
    compat_rank: bool = False
    order_command: tuple[str, ...] | None = None
    first_only_among_accepted: bool = True
    extra: dict = field(default_factory=dict)


#: Columns of the records that the stages read beside the block, and those that they write.
_READ = ("Energy_Ha", "num_atoms", "num_bonds", "CanonicalSMILES", "CompoundID")
_WRITTEN = ("residual", "z_residual", "energy_status", "filter_status", "filter_reason", "CanonicalSMILES", "CompoundID", "dedup_status", "dedup_reason", "ICONF", "validate_status", "validate_errors", "stereo_status", "reorder_status")


def run_stage(name: str, df: DataFrame, options: Options) -> DataFrame:
    """One stage over the narrow table of curate_tags; `__r` holds the facts of each record's block."""
    facts = F.col("__r")
    if name == "energy":
        return energy.energy_prefilter(df, options.threshold, counts=facts["counts"], written=True)
    if name == "filter":
        return chemfilter.filter_blocks(df, options.preset, options.elements, options.heavy, facts=facts)
    if name == "dedup":
        earlier = [F.expr(REJECTED[s]) for s in ("energy", "filter") if f"{s}_status" in df.columns]
        ok = None
        if options.first_only_among_accepted and earlier:
            ok = F.lit(True)
            for bad in earlier:
                ok = ok & ~F.coalesce(bad, F.lit(False))
        return dedup.deduplicate(df, ok, facts)
    if name == "validate":
        return integrity.integrity(df, facts.isNotNull(), facts["canonical"], (facts["num_atoms"], facts["num_bonds"]))
    if name == "stereo":
        # Written before it is read twice, so that the stages before run once.
        return stereo.stereo_filter(materialise(df), facts=facts)
    if name == "reorder":
        return df.withColumn("reorder_status", F.when(facts.isNull(), "failed").otherwise("ok"))
    raise ValueError(f"no stage {name}")


def curate_tags(batch: DataFrame, options: Options | None = None) -> DataFrame:
    """row_seq and what the stages say of each record: statuses, reasons, CanonicalSMILES, CompoundID, ICONF.

    Reads the records once. row_seq must be unique; base columns that are missing count as null, as far as stages need them.
    """
    options = options or Options()
    absent = {"Energy_Ha": "double", "num_atoms": "int", "num_bonds": "int", "CanonicalSMILES": "string", "CompoundID": "string"}
    read = [F.col(c) if c in batch.columns else F.lit(None).cast(absent[c]).alias(c) for c in _READ]
    batch = spread(batch)
    out = materialise(batch.select("row_seq", *read, chemfilter.block_record(batch, options.geometry).alias("__r")))
    for name in options.stages:
        out = run_stage(name, out, options)
        if options.on_reject == "drop":
            out = out.filter(~F.coalesce(F.expr(REJECTED[name]), F.lit(False)))
    made = [c for c in _WRITTEN if c in out.columns and ("dedup" in options.stages or c not in ("CanonicalSMILES", "CompoundID"))]
    return out.select("row_seq", *made)


def curate(batch: DataFrame, options: Options | None = None) -> DataFrame:
    """All stages over batch records, which need row_seq and the base columns: every record with its tags.

    The tags come in one join on row_seq; blocks are put in canonical order where that stage runs.
    """
    options = options or Options()
    tags = curate_tags(batch, options)
    kept = batch.drop(*[c for c in tags.columns if c != "row_seq"])
    out = kept.join(tags, "row_seq", "inner")
    if "reorder" in options.stages and "mol_block" in batch.columns:
        smiles = F.col("SMILES") if "SMILES" in batch.columns else F.lit(None).cast("string")
        if options.order_command:
            out = out.withColumn("__new", external_order(options.order_command)(F.col("mol_block")))
            out = out.withColumn("reorder_status", F.when(F.col("__new").isNull(), "failed").otherwise(F.col("reorder_status")))
            if options.on_reject == "drop":
                out = out.filter(F.col("__new").isNotNull())
        else:
            out = out.withColumn("__new", (reorder_block_by_rank if options.compat_rank else reorder_block)(F.col("mol_block"), smiles))
        out = out.withColumn("mol_block", F.coalesce("__new", "mol_block")).drop("__new")
    return out


def stage_report(df: DataFrame, stages: tuple[str, ...] = STAGES) -> DataFrame:
    """stage, status, rows of every status column there is: one pass over the rows."""
    columns = [s for s in stages if f"{s}_status" in df.columns]
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"{s}_status").alias("status")) for s in columns])).alias("x")
    return df.select(each).groupBy("x.stage", "x.status").agg(F.count(F.lit(1)).alias("rows"))


def failed(df: DataFrame, stages: tuple[str, ...] = ("validate", "reorder")) -> bool:
    """Whether a stage that must not reject anything has done so: what a command line turns into its exit code."""
    for s in stages:
        if f"{s}_status" in df.columns and df.filter(REJECTED[s]).head(1):
            return True
    return False


def still_rejected(df: DataFrame) -> DataFrame:
    """stage, rows: rows that a stage before validation turned down and that are still there."""
    have = [s for s in ("energy", "filter", "dedup") if f"{s}_status" in df.columns]
    counts = df.agg(*[F.count_if(F.coalesce(F.expr(REJECTED[s]), F.lit(False))).alias(s) for s in have])
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("rows")) for s in have])).alias("x")
    return counts.select(each).select("x.*").filter("rows > 0")


def nothing_to_fit(df: DataFrame) -> bool:
    """Whether the energy stage had no record to fit: rows there are, but none has a composition and a finite energy."""
    return bool(df.head(1)) and not df.filter("energy_status in ('ok', 'flagged')").head(1)


def reject_counts(rejects: DataFrame) -> DataFrame:
    """stage, rows of a written table of rejects, with the total of all stages in a row `total`."""
    counts = rejects.groupBy("stage").agg(F.count(F.lit(1)).alias("rows"))
    return counts.unionByName(counts.agg(F.lit("total").alias("stage"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")))


def rejects_by_stage(df: DataFrame) -> DataFrame:
    """stage, reason, row_seq: one row for each stage that turned a row down."""
    reasons = {"energy": F.col("energy_status"), "filter": F.coalesce("filter_reason", "filter_status"), "dedup": F.coalesce("dedup_reason", "dedup_status"), "validate": F.col("validate_errors"), "stereo": F.col("stereo_status"), "reorder": F.col("reorder_status")}
    have = [s for s in reasons if f"{s}_status" in df.columns]
    each = F.array(*[F.when(F.expr(REJECTED[s]), F.struct(F.lit(s).alias("stage"), reasons[s].alias("reason"))) for s in have])
    return df.select("row_seq", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x")).select("x.stage", "x.reason", "row_seq")


def funnel_report(df: DataFrame, total: int | None = None) -> DataFrame:
    """The funnel over tagged rows: stages in order; a row counts for the first stage that turned it down."""
    turned, earlier = [], F.lit(False)
    for s in STAGES:
        if f"{s}_status" in df.columns and s != "dedup":
            bad = F.coalesce(F.expr(REJECTED[s]), F.lit(False))
            turned.append((s, bad & ~earlier))
            earlier = earlier | bad
    return stats.funnel(df.withColumn("_kept", F.when(~earlier, F.col("CompoundID"))), turned, "_kept", total)
