"""Queries of the curation operators over the tables of molecules, and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.functions.arrow import block_flat, fingerprint, flat_smiles, smiles_state
from corundum.functions.arrow import smiles_descriptors as descriptors
from corundum.functions.chem import CHARGE_CODES, VALENCES_IN_BRACKETS
from corundum.functions.ids import compound_of
from corundum.functions.v2000 import block_valid, head_counts, head_line
from corundum.operators import assemble, chemfilter, contract, dedup, deliver, energy, integrity, similarity, stats, stereo
from corundum.plans import pipeline
from corundum.plans.data_quality import valid_blocks
from corundum.schema import FIT_ELEMENTS, PRESETS, REJECT_TAGS
from corundum.session import materialise, read_table, salted_join, share_out, spread
from corundum.sinks.writers import reject_records

# SQL pieces.
_KEY = "CASE WHEN regexp_matches(upper(regexp_replace(Zinc_id, '[^0-9A-Za-z]', '', 'g')), '^ZINC[0-9]+$') THEN CAST(substr(regexp_replace(Zinc_id, '[^0-9A-Za-z]', '', 'g'), 5) AS BIGINT) END"
_COMPOUND = "CASE WHEN regexp_matches(lower(regexp_replace(CompoundID, '[-{}\\s]', '', 'g')), '^[0-9a-f]{32}$') THEN lower(regexp_replace(CompoundID, '[-{}\\s]', '', 'g')) WHEN trim(CanonicalSMILES) <> '' THEN md5(CanonicalSMILES) END"
_ATOMS = f"""k AS (SELECT *, {_KEY} AS key FROM xyz),
f AS (SELECT key, min(loaded_at) AS loaded_at FROM k WHERE key IS NOT NULL GROUP BY 1),
a AS (SELECT k.key, k.xyz_seq, upper(substr(trim(atom), 1, 1)) || lower(substr(trim(atom), 2)) AS atom, charge FROM k JOIN f USING (key, loaded_at))"""


def _batch(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "batch").select(*columns)


def _molecules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble.atom_lists(read_table(spark, sf_dir, "xyz").select("xyz_seq", "Zinc_id", "atom", "final_x", "final_y", "final_z", "charge", "loaded_at"))


def contract_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tags of every record against the contract."""
    tags = ("Energy_Ha", "FormalCharge", "Multiplicity", "SMILES", "SourceID", "HOMO_Ha", "LUMO_Ha", "HL_Gap_Ha", "PartialCharges")
    done = contract.validate_contract(_batch(spark, sf_dir, "row_seq", *tags))
    return done.select("row_seq", F.concat_ws("; ", "errors").alias("errors"), F.concat_ws("; ", "warnings").alias("warnings"), "passed")


_MISSING = lambda tags, status: ", ".join(f"CASE WHEN {t} IS NULL THEN '{t}: missing ({status})' END" for t in tags)
_CONTRACT = f"""
WITH e AS (SELECT *, concat_ws('; ', {_MISSING(("Energy_Ha", "FormalCharge", "Multiplicity"), "required")}) AS missing,
  concat_ws('; ', {_MISSING(("SMILES", "SourceID"), "recommended")}, {_MISSING(("HOMO_Ha", "LUMO_Ha", "HL_Gap_Ha", "PartialCharges"), "optional")}) AS warnings,
  CASE WHEN Multiplicity <= 0 THEN 'Multiplicity: ' || Multiplicity || ' is not a positive integer' END AS wrong FROM batch)
SELECT row_seq, concat_ws('; ', nullif(missing, ''), wrong) AS errors, warnings, concat_ws('; ', nullif(missing, ''), wrong) = '' AS passed FROM e"""


def dedup_first_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First record of each compound."""
    keyed = _batch(spark, sf_dir, "row_seq", "CompoundID", "CanonicalSMILES").select("row_seq", compound_of(F.col("CompoundID"), F.col("CanonicalSMILES")).alias("compound_id"))
    return dedup.first_occurrence(keyed, "compound_id", "row_seq")


_DEDUP = f"""WITH c AS (SELECT row_seq, {_COMPOUND} AS compound_id FROM batch), r AS (SELECT *, row_number() OVER (PARTITION BY compound_id ORDER BY row_seq) AS n FROM c)
SELECT row_seq, compound_id, CASE WHEN compound_id IS NULL THEN NULL WHEN n = 1 THEN 'ok' ELSE 'conformer_duplicate' END AS dedup_status,
  CASE WHEN compound_id IS NOT NULL AND n = 1 THEN CAST(1 AS INTEGER) END AS ICONF FROM r"""


def unique_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3, A8."""
    keyed = _batch(spark, sf_dir, "row_seq", "CompoundID", "CanonicalSMILES", "Energy_Ha").select("row_seq", compound_of(F.col("CompoundID"), F.col("CanonicalSMILES")).alias("compound_id"), "Energy_Ha")
    return dedup.keep_first(keyed, "compound_id", "row_seq")


def collision_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and different structures of each stored id."""
    return dedup.collisions(_batch(spark, sf_dir, "CompoundID", "CanonicalSMILES"), "CompoundID", "CanonicalSMILES")


def energy_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4, F2 over the batch records' own structures."""
    done = energy.energy_prefilter(spread(_batch(spark, sf_dir, "row_seq", "Energy_Ha", "mol_block")))
    return done.select("row_seq", F.round("residual", 4).alias("residual"), F.round("z_residual", 4).alias("z_residual"), "energy_status")


def energy_outlier_ols_mad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4, F2 on orders: total price by the number of lines of each return flag."""
    lines = read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*[F.count_if(F.col("l_returnflag") == x).alias(f"n_{x}") for x in "ANR"])
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    done, _ = energy.flag_outliers(orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")), ["n_A", "n_N", "n_R"], "o_totalprice", 1.5)
    return done.select("o_orderkey", F.round("residual", 4).alias("residual"), F.round("z_residual", 4).alias("z_residual"), "energy_status")


_DET = lambda m: f"({m[0]}*({m[4]}*{m[8]}-{m[5]}*{m[7]})-{m[1]}*({m[3]}*{m[8]}-{m[5]}*{m[6]})+{m[2]}*({m[3]}*{m[7]}-{m[4]}*{m[6]}))"
_GRAM = ["aa", "an", "ar", "an", "nn", "nr", "ar", "nr", "rr"]
_SWAPPED = [[("ay", "ny", "ry")[i // 3] if i % 3 == j else g for i, g in enumerate(_GRAM)] for j in range(3)]
_OLS = f"""
WITH l AS (SELECT l_orderkey, count(*) FILTER (l_returnflag='A')::DOUBLE AS a, count(*) FILTER (l_returnflag='N')::DOUBLE AS n, count(*) FILTER (l_returnflag='R')::DOUBLE AS r FROM lineitem GROUP BY 1),
t AS (SELECT o_orderkey, a, n, r, o_totalprice AS y FROM orders JOIN l ON o_orderkey = l_orderkey),
g AS (SELECT sum(a*a) aa, sum(a*n) an, sum(a*r) ar, sum(n*n) nn, sum(n*r) nr, sum(r*r) rr, sum(a*y) ay, sum(n*y) ny, sum(r*y) ry FROM t),
b AS (SELECT {_DET(_SWAPPED[0])}/{_DET(_GRAM)} b1, {_DET(_SWAPPED[1])}/{_DET(_GRAM)} b2, {_DET(_SWAPPED[2])}/{_DET(_GRAM)} b3 FROM g),
e AS (SELECT o_orderkey, y - a*b1 - n*b2 - r*b3 AS res FROM t, b), m AS (SELECT median(res) AS m FROM e), d AS (SELECT median(abs(res - m)) AS d FROM e, m),
z AS (SELECT o_orderkey, res, 0.6745 * (res - m) / d AS z FROM e, m, d)
SELECT o_orderkey, round(res, 4) AS residual, round(z, 4) AS z_residual, CASE WHEN abs(z) > 1.5 THEN 'flagged' ELSE 'ok' END AS energy_status FROM z"""


def chemical_filter_presets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """each preset over every main row."""
    main = read_table(spark, sf_dir, "main").select("Zinc_id", "smile", "loaded_at")
    facts = main.withColumn("_f", smiles_state(F.col("smile")))
    reason = lambda p: F.when(F.col("_f").isNull(), "smiles_unparseable").otherwise(chemfilter.state_reason(F.col("_f.net_charge"), F.col("_f.charged_atoms"), F.col("_f.radicals"), p))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("preset"), reason(p).alias("filter_reason")) for p in PRESETS])).alias("x")
    out = facts.select("Zinc_id", "loaded_at", each).select("Zinc_id", "loaded_at", "x.*")
    return out.withColumn("filter_status", F.when(F.col("filter_reason").isNull(), "ok").otherwise("rejected"))


# An end that is written as a centre with one hydrogen and two neighbours lacks a bond.
_STATE = """WITH s AS (SELECT Zinc_id, smile, loaded_at, len(regexp_extract_all(smile, '\\+\\]')) AS p, len(regexp_extract_all(smile, '-\\]')) AS n,
  len(regexp_extract_all(smile, '\\[C@@?H\\]\\([A-Z][a-z]?\\)$')) AS u FROM main),
r AS (SELECT Zinc_id, loaded_at, preset, CASE WHEN smile IS NULL THEN 'smiles_unparseable' WHEN preset = 'none' THEN NULL
  WHEN p <> n THEN 'charge=' || CASE WHEN p > n THEN '+' ELSE '-' END || abs(p - n) WHEN preset = 'neutral_closed_shell' AND p > 0 THEN 'zwitterion'
  WHEN preset = 'neutral_closed_shell' AND u > 0 THEN 'radicals=' || u END AS filter_reason
  FROM s, (VALUES ('neutral_closed_shell'), ('neutral'), ('none')) v(preset))"""


def filter_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: reasons of the strictest preset over main."""
    strict = chemical_filter_presets(spark, sf_dir).filter("preset = 'neutral_closed_shell'")
    return chemfilter.reason_counts(strict)


def integrity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of F5 that its SQL expresses: counts, energies and ids of every record with a counts line.

    It takes truncated blocks and bad atom or bond lines; integrity_full is the whole check.
    """
    batch = _batch(spark, sf_dir, "row_seq", "mol_block", "num_atoms", "num_bonds", "CanonicalSMILES", "CompoundID", "Energy_Ha")
    atoms, _ = head_counts(head_line(F.col("mol_block")))
    return integrity.integrity(batch, atoms.isNotNull() & F.col("mol_block").contains("V2000")).select("row_seq", "validate_status", "validate_errors")


_INTEGRITY = """
WITH h AS (SELECT *, split_part(replace(mol_block, chr(13), ''), chr(10), 4) AS head FROM batch),
c AS (SELECT *, CASE WHEN regexp_matches(substr(head, 1, 3), '^ *[0-9]+ *$') THEN CAST(trim(substr(head, 1, 3)) AS INTEGER) END AS a,
  CASE WHEN regexp_matches(substr(head, 4, 3), '^ *[0-9]+ *$') THEN CAST(trim(substr(head, 4, 3)) AS INTEGER) END AS b FROM h),
e AS (SELECT row_seq, CASE WHEN a IS NULL OR mol_block IS NULL OR NOT contains(mol_block, 'V2000') THEN 'mol_block: could not parse' ELSE concat_ws('; ',
  CASE WHEN num_atoms IS DISTINCT FROM a THEN 'num_atoms mismatch: stored=' || coalesce(CAST(num_atoms AS VARCHAR), 'None') || ', mol=' || coalesce(CAST(a AS VARCHAR), 'None') END,
  CASE WHEN num_bonds IS DISTINCT FROM b THEN 'num_bonds mismatch: stored=' || coalesce(CAST(num_bonds AS VARCHAR), 'None') || ', mol=' || coalesce(CAST(b AS VARCHAR), 'None') END,
  CASE WHEN Energy_Ha IS NULL OR NOT isfinite(Energy_Ha) THEN 'Energy_Ha: not finite' END,
  CASE WHEN CompoundID <> '' AND CanonicalSMILES <> '' AND md5(CanonicalSMILES) <> CompoundID THEN 'CompoundID mismatch: stored=' || CompoundID || ', recomputed=' || md5(CanonicalSMILES) END) END AS errors FROM c)
SELECT row_seq, CASE WHEN coalesce(errors, '') = '' THEN 'ok' ELSE 'invalid' END AS validate_status, nullif(errors, '') AS validate_errors FROM e"""


def integrity_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F5, as the pipeline checks it: whole blocks, counts, SMILES round trip, energies and ids.

    The stored CanonicalSMILES may be another toolkit's text, so both sides are compared as this kernel writes them
    without stereo; an unreadable text is a mismatch.
    """
    batch = spread(_batch(spark, sf_dir, "row_seq", "mol_block", "num_atoms", "num_bonds", "CanonicalSMILES", "CompoundID", "Energy_Ha"))
    read = batch.withColumns({"__own": block_flat(F.col("mol_block")), "__stored": flat_smiles(F.col("CanonicalSMILES"))}).withColumn("__valid", F.col("__own").isNotNull())
    own = F.when(F.col("__stored") == F.col("__own"), F.col("CanonicalSMILES")).otherwise(F.col("__own"))
    return integrity.integrity(read, F.col("__valid"), own).select("row_seq", "validate_status", "validate_errors")


def mirror_pair_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 on lines: pairs of numbers whose mirror image is the swapped pair."""
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    lines = read_table(spark, sf_dir, "lineitem").withColumn("seq", order)
    a, b = (F.lpad(F.pmod(F.col(c), F.lit(50)).cast("string"), 2, "0") for c in ("l_orderkey", "l_suppkey"))
    done = dedup.mirror_removal(lines.withColumns({"a": a, "b": b}), F.concat("a", F.lit("|"), "b"), F.concat("b", F.lit("|"), "a"), "seq")
    return done.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "stereo_status")


_MIRROR = """
WITH s AS (SELECT *, l_orderkey % 50 AS a, l_suppkey % 50 AS b FROM lineitem),
w AS (SELECT *, row_number() OVER c AS n, first_value(a) OVER c AS fa, first_value(b) OVER c AS fb FROM s
  WINDOW c AS (PARTITION BY least(a, b), greatest(a, b) ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN n > 1 AND b = fa AND a = fb THEN 'removed_enantiomer' ELSE 'kept' END AS stereo_status FROM w"""


def stereo_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, P10, F9, W2 over the records' SMILES."""
    return stereo.stereo_filter(_batch(spark, sf_dir, "row_seq", "CanonicalSMILES")).select("row_seq", "stereo_status")


def nearest_neighbour_tanimoto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J6, A11 on signs of embeddings; the queries are the ids divisible by 20."""
    e = read_table(spark, sf_dir, "embeddings")
    word = F.aggregate(F.transform("embedding", lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("bigint"), i.cast("int"))).otherwise(0).cast("bigint")), F.lit(0).cast("bigint"), lambda s, b: s.bitwiseOR(b))
    done = similarity.nearest_neighbours(e.select("vec_id", F.array(word).alias("bits")), "vec_id", "bits")
    return done.select("query_id", F.round("max_tanimoto", 9).alias("max_tanimoto"))


_NEAREST = """
WITH b AS (SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS v FROM embeddings),
p AS (SELECT q.vec_id AS query_id, list_dot_product(q.v::DOUBLE[], r.v::DOUBLE[]) AS shared, list_sum(q.v) AS nq, list_sum(r.v) AS nr FROM b q JOIN b r ON q.vec_id % 20 = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, round(max(CASE WHEN nq + nr - shared = 0 THEN 0 ELSE shared / (nq + nr - shared) END), 9) AS max_tanimoto FROM p GROUP BY 1"""


def nearest_structures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every row of the batch divisible by 20, the largest similarity of its structure to a different one.

    Each structure that such a row has is asked once against all structures; all its rows get the answer. Rows without
    a readable SMILES have none and are left out.
    """
    batch = _batch(spark, sf_dir, "row_seq", "CanonicalSMILES").filter("CanonicalSMILES <> ''")
    asks = F.col("row_seq") % 20 == 0
    forms = batch.groupBy("CanonicalSMILES").agg(F.min("row_seq").alias("form_id"), F.bool_or(asks).alias("asks"))
    best = similarity.nearest_neighbours(share_out(forms).withColumn("bits", fingerprint(F.col("CanonicalSMILES"))), "form_id", "bits", asks="asks")
    known = forms.select("CanonicalSMILES", F.col("form_id").alias("query_id")).join(best, "query_id").select("CanonicalSMILES", "max_tanimoto")
    members = batch.filter(asks).select(F.col("row_seq").cast("bigint").alias("query_id"), "CanonicalSMILES")
    return salted_join(members, known, ["CanonicalSMILES"], "inner").select("query_id", "max_tanimoto")


def assemble_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records from main, atoms and bonds; charges are added as doubles, in the order of atoms."""
    done = assemble.assemble(*(read_table(spark, sf_dir, t) for t in ("main", "xyz", "bond")), exact=False)
    return done.select("SourceID", "SMILES", "Energy_Ha", "FormalCharge", "num_atoms", "num_bonds")


_ASSEMBLE = f"""
WITH {_ATOMS}, m AS (SELECT *, {_KEY} AS key FROM main WHERE energy_status = 'ok'),
x AS (SELECT key, count(*) AS n, CASE WHEN count(charge) = count(*) AND isfinite(sum(charge)) THEN CAST(round_even(sum(charge), 0) AS INTEGER) END AS q FROM a GROUP BY 1),
kb AS (SELECT *, {_KEY} AS key FROM bond), fb AS (SELECT key, min(loaded_at) AS loaded_at FROM kb WHERE key IS NOT NULL GROUP BY 1),
b AS (SELECT DISTINCT kb.key, atom1, atom2 FROM kb JOIN fb USING (key, loaded_at) WHERE atom1 > 0 AND atom2 > 0 AND atom1 <> atom2),
y AS (SELECT b.key, count(*) AS n FROM b JOIN x ON b.key = x.key AND atom1 <= x.n AND atom2 <= x.n GROUP BY 1)
SELECT 'ZINC' || lpad(CAST(m.key AS VARCHAR), 12, '0') AS SourceID, smile AS SMILES, "Internal_E(0K)" AS Energy_Ha, x.q AS FormalCharge,
  CAST(x.n AS INTEGER) AS num_atoms, CAST(coalesce(y.n, 0) AS INTEGER) AS num_bonds FROM m JOIN x USING (key) LEFT JOIN y USING (key)"""


def assembled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The assembled molecules' columns; charges are added exactly, so that ties are ties."""
    done = assemble.assemble(*(read_table(spark, sf_dir, t) for t in ("main", "xyz", "bond")))
    return done.select("SourceID", "SMILES", "Energy_Ha", "FormalCharge", "Multiplicity", "HOMO_Ha", "LUMO_Ha", "HL_Gap_Ha", "num_atoms", "num_bonds")


def built_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structure-file records of the assembled molecules; one that fits no block has a reason instead."""
    m = assemble.assemble(*(read_table(spark, sf_dir, t) for t in ("main", "xyz", "bond")))
    block = deliver.build_block(F.col("SourceID"), F.col("symbols"), F.col("coordinates"), F.col("bonds"))
    why = deliver.block_refusal(F.col("symbols"), F.col("coordinates"), F.col("bonds"))
    return m.select("SourceID", deliver.sdf_record(block, assemble.record_tags()).alias("record"), why.alias("reject_reason"))


_ALNUM = "upper(regexp_replace(Zinc_id, '[^0-9A-Za-z]', '', 'g'))"
_NAME = f"CASE WHEN regexp_matches({_ALNUM}, '^ZINC0*[0-9]{{1,18}}$') THEN 'ZINC' || lpad(ltrim(substr({_ALNUM}, 5), '0'), CAST(greatest(12, length(ltrim(substr({_ALNUM}, 5), '0'))) AS INTEGER), '0') ELSE nullif({_ALNUM}, '') END"
_ARRIVED = "coalesce(CAST(loaded_at AS TIMESTAMP), TIMESTAMP '9999-12-31')"
# Molecules from the first delivery of atoms and of bonds, one row each; sums of charges are exact.
_BUILT = f"""
ka AS (SELECT *, {_NAME} AS name, {_ARRIVED} AS arrived FROM xyz), kb AS (SELECT *, {_NAME} AS name, {_ARRIVED} AS arrived FROM bond),
ra AS (SELECT ka.*, upper(substr(trim(atom), 1, 1)) || lower(substr(trim(atom), 2)) AS symbol FROM ka JOIN (SELECT name, min(arrived) AS arrived FROM ka WHERE name IS NOT NULL GROUP BY 1) USING (name, arrived)),
atoms AS (SELECT name, CAST(count(*) AS INTEGER) AS n, list(symbol ORDER BY xyz_seq) AS symbols, list(final_x ORDER BY xyz_seq) AS xs, list(final_y ORDER BY xyz_seq) AS ys, list(final_z ORDER BY xyz_seq) AS zs,
  list(charge ORDER BY xyz_seq) AS charges, CASE WHEN count(TRY_CAST(charge AS DECIMAL(22,12))) = count(*) THEN sum(TRY_CAST(charge AS DECIMAL(22,12))) END AS q FROM ra GROUP BY 1),
rb AS (SELECT kb.name, atom1, atom2, min(bond_seq) AS s FROM kb JOIN (SELECT name, min(arrived) AS arrived FROM kb WHERE name IS NOT NULL GROUP BY 1) USING (name, arrived)
  WHERE atom1 > 0 AND atom2 > 0 AND atom1 <> atom2 GROUP BY ALL),
bonds AS (SELECT name, list([atom1, atom2] ORDER BY s) AS pairs FROM rb JOIN atoms USING (name) WHERE atom1 <= n AND atom2 <= n GROUP BY 1),
built AS (SELECT m.name AS SourceID, smile AS SMILES, "Internal_E(0K)" AS Energy_Ha, CAST(round_even(q, 0) AS INTEGER) AS FormalCharge, HOMO AS HOMO_Ha, LUMO AS LUMO_Ha, HL_gap AS HL_Gap_Ha, atoms.*, coalesce(pairs, []) AS pairs
  FROM (SELECT *, {_NAME} AS name FROM main WHERE energy_status = 'ok') m JOIN atoms USING (name) LEFT JOIN bonds USING (name))"""
_ASSEMBLED = f"WITH {_BUILT} SELECT SourceID, SMILES, Energy_Ha, FormalCharge, CAST(1 AS INTEGER) AS Multiplicity, HOMO_Ha, LUMO_Ha, HL_Gap_Ha, n AS num_atoms, CAST(len(pairs) AS INTEGER) AS num_bonds FROM built"
_TAG = lambda name, text: f"coalesce('> <{name}>' || chr(10) || {text} || chr(10) || chr(10), '')"
_RECORDS = f"""
WITH {_BUILT}, why AS (SELECT *, CASE WHEN n > 999 OR len(pairs) > 999 THEN 'beyond 999 atoms or bonds' WHEN len(list_filter(xs || ys || zs, lambda v: v IS NULL)) > 0 THEN 'a coordinate is missing' END AS reject_reason FROM built)
SELECT SourceID, reject_reason, CASE WHEN reject_reason IS NULL THEN concat_ws(chr(10), SourceID, '  corundum', '', printf('%3d%3d', n, len(pairs)) || '  0  0  0  0  0  0  0  0999 V2000',
  array_to_string(list_transform(range(1, n + 1), lambda i: printf('%10.4f%10.4f%10.4f %-3s 0  0  0  0  0  0  0  0  0  0  0  0', xs[i], ys[i], zs[i], symbols[i])), chr(10)),
  CASE WHEN len(pairs) > 0 THEN array_to_string(list_transform(pairs, lambda p: printf('%3d%3d  1  0', p[1], p[2])), chr(10)) END, 'M  END') || chr(10)
  || {' || '.join([_TAG("Energy_Ha", "printf('%.8f', Energy_Ha)"), _TAG("FormalCharge", "CAST(FormalCharge AS VARCHAR)"), _TAG("Multiplicity", "'1'"), _TAG("SMILES", "SMILES"), _TAG("SourceID", "SourceID"),
    *[_TAG(t, f"printf('%.6f', {t})") for t in ("HOMO_Ha", "LUMO_Ha", "HL_Gap_Ha")], _TAG("PartialCharges", "array_to_string(list_transform(charges, lambda c: coalesce(printf('%.6f', c), 'nan')), ' ')")])} || '$$$$' || chr(10) END AS record FROM why"""


def composition_formula(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formula and CNSO of each molecule's first delivery."""
    done = deliver.with_composition(_molecules(spark, sf_dir), F.col("symbols"))
    return done.select(F.col("key").alias("zinc_id"), "Formula", "Nat", "CNSO")


_FORMULA = f"""
WITH {_ATOMS}, c AS (SELECT key, atom, count(*) AS n FROM a WHERE atom IS NOT NULL GROUP BY ALL),
t AS (SELECT key, CAST(count(*) AS INTEGER) AS Nat, CAST(count(*) FILTER (atom IN ('C','N','S','O')) AS INTEGER) AS CNSO FROM a GROUP BY 1)
SELECT 'ZINC' || lpad(CAST(key AS VARCHAR), 12, '0') AS zinc_id, string_agg(atom || CASE WHEN n > 1 THEN CAST(n AS VARCHAR) ELSE '' END, '' ORDER BY atom) AS Formula, any_value(Nat) AS Nat, any_value(CNSO) AS CNSO
FROM c JOIN t USING (key) GROUP BY key"""


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _molecules(spark, sf_dir).withColumns(energy.element_counts(F.col("symbols")))


def feature_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Molecules that have each element."""
    return energy.feature_presence(_counted(spark, sf_dir), [f"n_{e}" for e in FIT_ELEMENTS])


_PRESENCE = f"WITH {_ATOMS}, v(element) AS (VALUES {', '.join(f'({e!r})' for e in FIT_ELEMENTS)}) SELECT element, count(DISTINCT key) AS molecules FROM v LEFT JOIN a ON atom = element GROUP BY 1"


def element_whitelist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 (documented option): molecules of whitelisted elements with 10 to 30 heavy atoms."""
    m, heavy = _molecules(spark, sf_dir), F.size(F.filter("symbols", lambda s: s != "H"))
    good = m.filter(F.forall("symbols", lambda s: s.isin("H", "C", "N", "O", "F")) & heavy.between(10, 30))
    return good.select(F.col("key").alias("zinc_id"), heavy.alias("heavy_atoms"))


_WHITELIST = f"""WITH {_ATOMS} SELECT 'ZINC' || lpad(CAST(key AS VARCHAR), 12, '0') AS zinc_id, CAST(count(*) FILTER (atom <> 'H') AS INTEGER) AS heavy_atoms
FROM a GROUP BY key HAVING bool_and(atom IN ('H','C','N','O','F')) AND count(*) FILTER (atom <> 'H') BETWEEN 10 AND 30"""


def exclude_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F10 (documented option): records that are no flagged outliers and not rejected."""
    batch = _batch(spark, sf_dir, "row_seq", "energy_status", "filter_status")
    return reduce(lambda df, x: chemfilter.exclude(df, *x), (("energy_status", "flagged"), ("filter_status", "rejected")), batch).select("row_seq")


def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: rows of each status of each stage."""
    return pipeline.stage_report(_batch(spark, sf_dir, *[f"{s}_status" for s in pipeline.STAGES]))


def histogram_50(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 of the energies."""
    return stats.histogram(_batch(spark, sf_dir, "Energy_Ha"), "Energy_Ha").select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "rows")


_HISTOGRAM = """
WITH v AS (SELECT Energy_Ha AS v FROM batch WHERE isfinite(Energy_Ha)), l AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
c AS (SELECT CAST(least(floor((v - lo) * 50 / (hi - lo)), 49) AS INTEGER) AS bin, count(*) AS n FROM v, l GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / 50), 6) AS low, round(lo + (i + 1) * ((hi - lo) / 50), 6) AS high, coalesce(n, 0) AS rows FROM range(50) r(i) CROSS JOIN l LEFT JOIN c ON bin = i"""


def range_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 of the atom counts."""
    return stats.range_buckets(_batch(spark, sf_dir, "num_atoms"), "num_atoms").withColumn("share", F.round("share", 9))


_BUCKETS = " UNION ALL ".join(f"SELECT {lo} AS low, {hi} AS high, count(*) FILTER (num_atoms BETWEEN {lo} AND {hi}) AS rows, round(count(*) FILTER (num_atoms BETWEEN {lo} AND {hi}) / count(num_atoms), 9) AS share FROM batch" for lo, hi in stats.ATOM_RANGES + stats.ATOM_PEAKS)


def descriptor_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 over stored columns."""
    done = stats.describe(_batch(spark, sf_dir, "Energy_Ha", "num_atoms", "HOMO_Ha"), ["Energy_Ha", "num_atoms", "HOMO_Ha"])
    return done.select("name", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "min", "max")])


_SUMMARY = " UNION ALL ".join(f"SELECT '{c}' AS name, count(v) AS n, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(min(v), 6) AS min, round(max(v), 6) AS max FROM (SELECT CAST({c} AS DOUBLE) AS v FROM batch) WHERE isfinite(v)" for c in ("Energy_Ha", "num_atoms", "HOMO_Ha"))


def threshold_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9."""
    tests = {"gap_below_0.3": ("HL_Gap_Ha", F.col("HL_Gap_Ha") < 0.3), "homo_above_-0.25": ("HOMO_Ha", F.col("HOMO_Ha") > -0.25)}
    return stats.threshold_share(_batch(spark, sf_dir, "HL_Gap_Ha", "HOMO_Ha"), tests).withColumn("share", F.round("share", 9))


_SHARES = " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) FILTER ({c}) AS rows, count(*) AS n, round(count(*) FILTER ({c}) / count(*), 9) AS share FROM batch WHERE isfinite({v})" for n, v, c in (("gap_below_0.3", "HL_Gap_Ha", "HL_Gap_Ha < 0.3"), ("homo_above_-0.25", "HOMO_Ha", "HOMO_Ha > -0.25")))


def curation_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W4 over the stored statuses."""
    return pipeline.funnel_report(_batch(spark, sf_dir, "CompoundID", *[f"{s}_status" for s in pipeline.STAGES]))


_FUNNEL = """
WITH s AS (SELECT CompoundID, CASE WHEN energy_status <> 'ok' THEN 1 WHEN filter_status <> 'ok' THEN 2 WHEN validate_status <> 'ok' THEN 3
  WHEN stereo_status = 'removed_enantiomer' THEN 4 WHEN reorder_status <> 'ok' THEN 5 ELSE 0 END AS k FROM batch),
n AS (SELECT count(*) AS total, count(DISTINCT CompoundID) FILTER (k = 0) AS uniq, count(*) FILTER (k = 0) AS kept FROM s),
r AS (SELECT i AS stage_no, name AS stage, CASE WHEN i = 6 THEN greatest(0, kept - uniq) WHEN i IN (0, 7) THEN 0 ELSE (SELECT count(*) FROM s WHERE k = i) END AS rejected,
  CASE WHEN i = 7 THEN uniq WHEN i = 6 THEN kept - greatest(0, kept - uniq) ELSE total - (SELECT count(*) FROM s WHERE k BETWEEN 1 AND i) END AS passed
  FROM n, (VALUES (0, 'input'), (1, 'energy'), (2, 'filter'), (3, 'validate'), (4, 'stereo'), (5, 'reorder'), (6, 'conformers'), (7, 'unique')) v(i, name))
SELECT CAST(stage_no AS INTEGER) AS stage_no, stage, rejected, passed FROM r"""


def xyz_text_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element and coordinates of every valid block's atom lines."""
    batch = spread(_batch(spark, sf_dir, "row_seq", "mol_block"))
    return batch.select("row_seq", deliver.xyz_text(F.col("mol_block")).alias("xyz")).filter("xyz is not null")


def smiles_energy_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3, P4, F2 of main: energy outliers by the composition of the SMILES."""
    main = read_table(spark, sf_dir, "main").drop("energy_status")
    done = energy.smiles_prefilter(main)
    return done.select("Zinc_id", "loaded_at", "NAT", "S_count", "E_per_atom", F.round("z_residual", 6).alias("z_residual"), "energy_status")


def smiles_energy_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table of flagged rows, with its columns."""
    return energy.flagged_rows(energy.smiles_prefilter(read_table(spark, sf_dir, "main").drop("energy_status")))


def stats_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics table of the batch; similarity is asked for rows divisible by 20."""
    return stats.stats_table(_batch(spark, sf_dir, "row_seq", "CompoundID", "SourceID", "CanonicalSMILES", "Energy_Ha"), tanimoto=True, divisor=20)


def descriptor_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 over the statistics table."""
    table = materialise(stats.stats_table(_batch(spark, sf_dir, "row_seq", "CompoundID", "SourceID", "CanonicalSMILES", "Energy_Ha")))
    done = stats.descriptor_report(table)
    return done.select("name", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "min", "max", "share_below_limit")])


def tanimoto_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 over similarities of embeddings."""
    done = stats.tanimoto_report(materialise(nearest_neighbour_tanimoto(spark, sf_dir)), key="query_id", order="query_id")
    return done.select("n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "max")], "twins", F.round("twins_share", 6).alias("twins_share"), "near_duplicates", F.round("near_duplicates_share", 6).alias("near_duplicates_share"))


_TANIMOTO = f"""WITH t AS ({_NEAREST}) SELECT count(*) AS n, round(avg(max_tanimoto), 6) AS mean, round(median(max_tanimoto), 6) AS median, round(max(max_tanimoto), 6) AS max, count(*) FILTER (max_tanimoto = 1) AS twins,
  round(count(*) FILTER (max_tanimoto = 1) / count(*), 6) AS twins_share, count(*) FILTER (max_tanimoto > 0.85) AS near_duplicates, round(count(*) FILTER (max_tanimoto > 0.85) / count(*), 6) AS near_duplicates_share FROM t"""
_REJECT_TAGS = [*[t for t in REJECT_TAGS], "CompoundID", "filter_status", "CanonicalSMILES", "dedup_status", "dedup_reason", "ICONF", "stereo_status", "reorder_status", "validate_status", "validate_errors", "family", "batch_file"]
_REJECTS = f"SELECT mol_block || chr(10) || {' || '.join(_TAG(t, f'CAST({t} AS VARCHAR)') for t in [*_REJECT_TAGS, 'reject_reason'])} || '$$$$' || chr(10) AS value FROM (SELECT *, filter_reason AS reject_reason FROM batch) WHERE reject_reason IS NOT NULL AND mol_block IS NOT NULL"
# Least squares by Gauss-Jordan steps over the normal matrix; an element that no row has keeps coefficient 0.
_FIT = [f"c[{i + 1}]" for i in range(len(FIT_ELEMENTS))]
_PIVOT = "m[k][k]"
_FITTED = f"""
s AS (SELECT row_seq, Energy_Ha, CASE WHEN regexp_full_match(substr(l[4], 1, 3), '[[:space:]]*[0-9]+[[:space:]]*') THEN list_transform(l[5:4 + CAST(trim(substr(l[4], 1, 3)) AS INTEGER)], lambda x: trim(substr(x, 32, 3))) END AS s FROM l),
t AS (SELECT row_seq, Energy_Ha AS e, CASE WHEN len(s) > 0 THEN [{', '.join(f"len(list_filter(s, lambda x: x = '{e}'))::DOUBLE" for e in FIT_ELEMENTS)}] END AS c FROM s),
f AS (SELECT * FROM t WHERE c IS NOT NULL AND isfinite(e)),
gj AS (SELECT 1 AS k, [{', '.join('[' + ', '.join(f'sum({a} * {b})' for b in [*_FIT, 'e']) + ']' for a in _FIT)}] AS m FROM f
  UNION ALL SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN {_PIVOT} = 0 THEN r WHEN i = k THEN list_transform(r, lambda v: v / {_PIVOT}) ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / {_PIVOT}) END) FROM gj WHERE k <= {len(FIT_ELEMENTS)}),
b AS (SELECT list_transform(m, lambda r, i: CASE WHEN r[i] = 0 THEN 0 ELSE r[{len(FIT_ELEMENTS) + 1}] END) AS b FROM gj WHERE k = {len(FIT_ELEMENTS) + 1}),
r AS (SELECT row_seq, c, CASE WHEN c IS NOT NULL AND isfinite(e) THEN e - list_sum(list_transform(c, lambda v, i: v * b[i])) END AS res FROM t, b),
m1 AS (SELECT median(res) AS m FROM r), d1 AS (SELECT median(abs(res - m)) AS d FROM r, m1),
z AS (SELECT row_seq, c, res, 0.6745 * (res - m) / d AS z FROM r, m1, d1),
es AS (SELECT row_seq, round(res, 4) AS residual, round(z, 4) AS z_residual, CASE WHEN c IS NULL THEN 'mol_corrupt' WHEN res IS NULL THEN 'energy_nonfinite' WHEN abs(z) > 3.5 THEN 'flagged' ELSE 'ok' END AS energy_status FROM z)"""
_ENERGY = f"WITH RECURSIVE l AS (SELECT row_seq, Energy_Ha, string_split(mol_block, chr(10)) AS l FROM batch), {_FITTED} SELECT * FROM es"
# The stages that need no canonical text, over valid blocks.
_STAGES = f"""
WITH RECURSIVE {valid_blocks('batch', 'row_seq').replace('lines AS', 'lines_ AS').replace('FROM lines)', 'FROM lines_)')},
l AS (SELECT row_seq, Energy_Ha, CASE WHEN valid THEN l END AS l FROM batch JOIN blocks USING (row_seq) JOIN heads USING (row_seq)), {_FITTED},
e AS (SELECT row_seq, valid, CASE WHEN NOT valid THEN 'mol_block: could not parse' ELSE concat_ws('; ',
  CASE WHEN num_atoms IS DISTINCT FROM n THEN 'num_atoms mismatch: stored=' || coalesce(CAST(num_atoms AS VARCHAR), 'None') || ', mol=' || n END,
  CASE WHEN num_bonds IS DISTINCT FROM m THEN 'num_bonds mismatch: stored=' || coalesce(CAST(num_bonds AS VARCHAR), 'None') || ', mol=' || m END,
  CASE WHEN Energy_Ha IS NULL OR NOT isfinite(Energy_Ha) THEN 'Energy_Ha: not finite' END) END AS errors FROM batch JOIN blocks USING (row_seq) JOIN heads USING (row_seq))
SELECT row_seq, energy_status, CASE WHEN errors = '' THEN 'ok' ELSE 'invalid' END AS validate_status, nullif(errors, '') AS validate_errors, CASE WHEN valid THEN 'ok' ELSE 'failed' END AS reorder_status FROM e JOIN es USING (row_seq)"""
_CODES = " ".join(f"WHEN '{code}' THEN {q}" for code, q in CHARGE_CODES.items())
_VALENCE_ROWS = ", ".join(f"('{e}', {v}, '{'abs' if e in ('C', 'Si', 'Ge', 'H') else 'minus' if e in ('B', 'Al') else 'plus'}')" for e, vs in VALENCES_IN_BRACKETS.items() for v in vs)
# Charges and radicals of blocks of plain bonds: M  CHG lines before atom codes; the least valence that holds an atom's bonds.
_BLOCK_FILTER = f"""
WITH {valid_blocks('batch', 'row_seq')},
k AS (SELECT row_seq, l, n, m, list_filter(l[5 + n + m:], lambda x: x LIKE 'M  CHG%') AS chg FROM heads JOIN blocks USING (row_seq) WHERE valid),
i AS (SELECT row_seq, n, chg, unnest(range(1, n + 1)) AS i, l FROM k),
w AS (SELECT row_seq, unnest(chg) AS line FROM k), w2 AS (SELECT row_seq, string_split_regex(trim(substr(line, 10)), ' +') AS t FROM w),
p AS (SELECT row_seq, unnest(list_transform(range(1, len(t), 2), lambda j: [CAST(t[j] AS INTEGER), CAST(t[j + 1] AS INTEGER)])) AS p FROM w2),
a AS (SELECT i.row_seq, i.i, trim(substr(l[4 + i.i], 32, 3)) AS sym, CASE WHEN len(chg) > 0 THEN coalesce((SELECT max(p.p[2]) FROM p WHERE p.row_seq = i.row_seq AND p.p[1] = i.i), 0)
  ELSE CASE trim(substr(l[4 + i.i], 37, 3)) {_CODES} ELSE 0 END END AS q FROM i),
b AS (SELECT row_seq, unnest(l[5 + n:4 + n + m]) AS x FROM k), b2 AS (SELECT row_seq, CAST(trim(substr(x, 1, 3)) AS INTEGER) AS i, CAST(trim(substr(x, 4, 3)) AS INTEGER) AS j, CAST(trim(substr(x, 7, 3)) AS INTEGER) AS o FROM b),
u AS (SELECT row_seq, i, sum(o) AS used FROM (SELECT row_seq, i, o FROM b2 UNION ALL SELECT row_seq, j, o FROM b2) GROUP BY ALL),
v AS (SELECT row_seq, i, min(valence + CASE kind WHEN 'abs' THEN -abs(q) WHEN 'minus' THEN -q ELSE q END - coalesce(used, 0)) FILTER (valence + CASE kind WHEN 'abs' THEN -abs(q) WHEN 'minus' THEN -q ELSE q END >= coalesce(used, 0)) AS free
  FROM a LEFT JOIN u USING (row_seq, i) JOIN (VALUES {_VALENCE_ROWS}) t(sym, valence, kind) USING (sym) GROUP BY ALL),
f AS (SELECT row_seq, sum(q) AS net, count(*) FILTER (q <> 0) AS charged FROM a GROUP BY 1), g AS (SELECT row_seq, CAST(sum(coalesce(free, 0)) AS INTEGER) AS radicals FROM v GROUP BY 1),
r AS (SELECT batch.row_seq, blocks.valid, CASE WHEN NOT blocks.valid THEN 'could not parse mol_block' WHEN net <> 0 THEN 'charge=' || CASE WHEN net > 0 THEN '+' ELSE '-' END || abs(net)
  WHEN charged > 0 THEN 'zwitterion' WHEN radicals > 0 THEN 'radicals=' || radicals END AS filter_reason FROM batch JOIN blocks USING (row_seq) LEFT JOIN f USING (row_seq) LEFT JOIN g USING (row_seq))
SELECT row_seq, CASE WHEN NOT valid THEN 'mol_corrupt' WHEN filter_reason IS NULL THEN 'ok' ELSE 'rejected' END AS filter_status, filter_reason FROM r"""
_XYZ = f"""
WITH {valid_blocks('batch', 'row_seq')}
SELECT row_seq, array_to_string(list_transform(l[5:4 + n], lambda x: printf('%-2s  %.6f  %.6f  %.6f', trim(substr(x, 32, 3)), CAST(trim(substr(x, 1, 10)) AS DOUBLE), CAST(trim(substr(x, 11, 10)) AS DOUBLE), CAST(trim(substr(x, 21, 10)) AS DOUBLE))), chr(10)) || chr(10) AS xyz
FROM heads JOIN blocks USING (row_seq) WHERE valid AND n > 0"""


def smiles_descriptors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptors of every record of the batch; each structure is worked out once."""
    batch = _batch(spark, sf_dir, "row_seq", "CompoundID", "SourceID", "CanonicalSMILES", "Energy_Ha")
    forms = share_out(batch.filter("CanonicalSMILES <> ''").groupBy("CanonicalSMILES").agg(F.count(F.lit(1)).alias("__rows"))).withColumn("_f", descriptors(F.col("CanonicalSMILES")))
    met = salted_join(batch, forms, ["CanonicalSMILES"], weight="__rows", by=["row_seq"])
    return met.select("row_seq", "CompoundID", "SourceID", "CanonicalSMILES", *[F.col(f"_f.{c}").alias(c) for c in ("MolWt", "TPSA", "logP", "nrot", "num_atoms", "fragments")], "Energy_Ha")


def frame_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training frames of every record with a readable block; chemfilter.exclude leaves records out by status."""
    batch = read_table(spark, sf_dir, "batch")
    return deliver.frames(spread(batch).select("row_seq", "mol_block", "SourceID", "CompoundID", "FormalCharge", "Multiplicity", "Energy_Ha", "CanonicalSMILES", "ICONF"))


def reject_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: structure records of rejected rows with their reason."""
    return reject_records(read_table(spark, sf_dir, "batch").drop("computed_at", "loaded_at"), "filter_reason")


def curation_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the batch records as they were delivered."""
    base = _batch(spark, sf_dir, "row_seq", "Energy_Ha", "FormalCharge", "Multiplicity", "SMILES", "SourceID", "num_atoms", "num_bonds", "mol_block")
    done = pipeline.curate_tags(base)
    return done.select("row_seq", "CompoundID", *[f"{s}_status" for s in pipeline.STAGES], "filter_reason", "ICONF", "validate_errors")


def curation_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline with the stages that SQL can check: energies, integrity and order."""
    base = _batch(spark, sf_dir, "row_seq", "Energy_Ha", "FormalCharge", "SMILES", "num_atoms", "num_bonds", "mol_block")
    done = pipeline.curate_tags(base, pipeline.Options(stages=("energy", "validate", "reorder")))
    return done.select("row_seq", "energy_status", "validate_status", "validate_errors", "reorder_status")


def block_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the strictest preset over the blocks' own bonds and charges."""
    batch = spread(_batch(spark, sf_dir, "row_seq", "mol_block"))
    return chemfilter.filter_blocks(batch).select("row_seq", "filter_status", "filter_reason")


_FUNCTIONS = (
    contract_validate, dedup_first_occurrence, unique_keep_first, collision_count, energy_outliers, energy_outlier_ols_mad, chemical_filter_presets, filter_reason_counts,
    integrity_check, integrity_full, mirror_pair_removal, stereo_filter, nearest_neighbour_tanimoto, nearest_structures, assemble_left_join, built_records, composition_formula, feature_presence,
    element_whitelist, exclude_filter, status_counts, histogram_50, range_buckets, descriptor_summary, threshold_share, curation_funnel, smiles_descriptors, frame_export, reject_export,
    curation_pipeline, assembled_records, xyz_text_export, smiles_energy_prefilter, smiles_energy_flagged, stats_summary, descriptor_report, tanimoto_report,
    curation_stages, block_filter,
)

QUERIES = {f.__name__: f for f in _FUNCTIONS}
SQL = {
    "contract_validate": _CONTRACT,
    "assembled_records": _ASSEMBLED,
    "block_filter": _BLOCK_FILTER,
    "curation_stages": _STAGES,
    "built_records": _RECORDS,
    "reject_export": _REJECTS,
    "energy_outliers": _ENERGY,
    "xyz_text_export": _XYZ,
    "tanimoto_report": _TANIMOTO,
    "dedup_first_occurrence": _DEDUP,
    "unique_keep_first": f"WITH c AS (SELECT row_seq, {_COMPOUND} AS compound_id, Energy_Ha FROM batch) SELECT row_seq, compound_id, Energy_Ha FROM c WHERE compound_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY compound_id ORDER BY row_seq) = 1",
    "collision_count": "SELECT CompoundID, count(*) AS rows, count(DISTINCT CanonicalSMILES) AS forms FROM batch WHERE CompoundID IS NOT NULL GROUP BY 1",
    "energy_outlier_ols_mad": _OLS,
    "chemical_filter_presets": _STATE + " SELECT *, CASE WHEN filter_reason IS NULL THEN 'ok' ELSE 'rejected' END AS filter_status FROM r",
    "filter_reason_counts": _STATE + " SELECT filter_reason, count(*) AS rows FROM r WHERE preset = 'neutral_closed_shell' AND filter_reason IS NOT NULL GROUP BY 1",
    "integrity_check": _INTEGRITY,
    "mirror_pair_removal": _MIRROR,
    "nearest_neighbour_tanimoto": _NEAREST,
    "assemble_left_join": _ASSEMBLE,
    "composition_formula": _FORMULA,
    "feature_presence": _PRESENCE,
    "element_whitelist": _WHITELIST,
    "exclude_filter": "SELECT row_seq FROM batch WHERE energy_status IS DISTINCT FROM 'flagged' AND filter_status IS DISTINCT FROM 'rejected'",
    "status_counts": " UNION ALL ".join(f"SELECT '{s}' AS stage, {s}_status AS status, count(*) AS rows FROM batch GROUP BY 2" for s in pipeline.STAGES),
    "histogram_50": _HISTOGRAM,
    "range_buckets": _BUCKETS,
    "descriptor_summary": _SUMMARY,
    "threshold_share": _SHARES,
    "curation_funnel": _FUNNEL,
}
