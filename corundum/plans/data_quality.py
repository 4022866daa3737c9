"""Queries of the general data-quality problems: rows that fail to parse (p2) and orphan references (p4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corundum.functions.v2000 import ELEMENTS
from corundum.operators.orphans import orphan_counts, orphan_references
from corundum.operators.parse_errors import RAW_FIELDS, judge_batch, judge_raw, loaded, rejects
from corundum.session import read_table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = rejects(judge_raw(read_table(spark, sf_dir, "batch_raw")), "raw_id", "batch_raw")
    batch = rejects(judge_batch(read_table(spark, sf_dir, "batch").select("row_seq", "Energy_Ha", "FormalCharge", "mol_block")), "row_seq", "batch")
    return batch.unionByName(raw)


def p2_loaded_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded(judge_raw(read_table(spark, sf_dir, "batch_raw")))


def p2_loaded_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded batch records, whole."""
    return loaded(judge_batch(read_table(spark, sf_dir, "batch")))


def p2_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed lines with the cheapest edits that mend them, and what these make of the line."""
    return judge_raw(read_table(spark, sf_dir, "batch_raw")).filter("line_edits is not null").select("raw_id", F.col("reasons")[0].alias("reason"), "line_edits", "line_mended")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    main, xyz, bond = (read_table(spark, sf_dir, t) for t in ("main", "xyz", "bond"))
    return orphan_references(main, {"xyz": xyz, "bond": bond})


def p4_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_counts(p4_found(spark, sf_dir))


_P4 = """
WITH n(t, raw, loaded_at, deleted_at) AS (
  SELECT 'main', Zinc_id, loaded_at, deleted_at FROM main
  UNION ALL SELECT DISTINCT 'xyz', Zinc_id, loaded_at, NULL FROM xyz
  UNION ALL SELECT DISTINCT 'bond', Zinc_id, loaded_at, NULL FROM bond),
k AS (SELECT t, loaded_at, deleted_at, upper(regexp_replace(raw, '[^0-9A-Za-z]', '', 'g')) AS a FROM n),
m AS (SELECT t, loaded_at, deleted_at, CASE WHEN regexp_matches(a, '^ZINC[0-9]+$')
        THEN 'ZINC' || lpad(CAST(CAST(substr(a, 5) AS BIGINT) AS VARCHAR), 12, '0') ELSE a END AS z FROM k WHERE a <> ''),
p AS (SELECT z, loaded_at, deleted_at FROM m WHERE t = 'main'),
r AS (SELECT DISTINCT t, z, loaded_at FROM m WHERE t <> 'main'),
j AS (SELECT r.t, r.z, r.loaded_at, count(p.z) AS n, count(*) FILTER (WHERE p.loaded_at <= r.loaded_at) AS known,
        count(*) FILTER (WHERE p.loaded_at <= r.loaded_at AND (p.deleted_at IS NULL OR p.deleted_at > r.loaded_at)) AS live
      FROM r LEFT JOIN p USING (z) GROUP BY 1, 2, 3),
f AS (SELECT DISTINCT t AS table_name, z AS zinc_id, strftime(loaded_at, '%Y-%m') AS period,
        CASE WHEN n = 0 THEN 'missing' WHEN known = 0 THEN 'late' ELSE 'deleted' END AS kind FROM j WHERE live = 0
      UNION SELECT DISTINCT 'main', z, strftime(loaded_at, '%Y-%m'), 'missing' FROM p WHERE z NOT IN (SELECT z FROM r WHERE t = 'xyz'))
"""

_ELEMENTS = ", ".join(f"'{e}'" for e in ELEMENTS)
_NUMBER = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
_COORDINATE = lambda at: f"regexp_full_match(substr(x, {at}, 10), ' *{_NUMBER} *') AND coalesce(isfinite(TRY_CAST(trim(substr(x, {at}, 10)) AS DOUBLE)), false)"


def valid_blocks(table: str, key: str) -> str:
    """Common table expressions `lines` and `blocks` (key, valid) over a table with mol_block: the rules for a block, line by line."""
    return f"""lines AS (SELECT {key}, string_split(replace(regexp_replace(mol_block, '[\\r\\n]+$', ''), chr(13) || chr(10), chr(10)), chr(10)) AS l FROM {table}),
heads AS (SELECT *, CASE WHEN regexp_full_match(substr(l[4], 1, 3), ' *[0-9]+ *') THEN CAST(trim(substr(l[4], 1, 3)) AS INTEGER) END AS n,
  CASE WHEN regexp_full_match(substr(l[4], 4, 3), ' *[0-9]+ *') THEN CAST(trim(substr(l[4], 4, 3)) AS INTEGER) END AS m FROM lines),
blocks AS (SELECT {key}, coalesce(n IS NOT NULL AND m IS NOT NULL AND l[4] LIKE '%V2000' AND l[len(l)] = 'M  END' AND len(l) > 4 + n + m
  AND len(list_filter(l[5:4 + n], lambda x: trim(substr(x, 32, 3), ' ') IN ({_ELEMENTS}) AND {' AND '.join(_COORDINATE(i) for i in (1, 11, 21))})) = n
  AND len(list_filter(l[5 + n:4 + n + m], lambda x: regexp_full_match(substr(x, 1, 9), '[0-9 ]*') AND coalesce(TRY_CAST(trim(substr(x, 1, 3)) AS INTEGER) BETWEEN 1 AND n
    AND TRY_CAST(trim(substr(x, 4, 3)) AS INTEGER) BETWEEN 1 AND n AND trim(substr(x, 1, 3))::VARCHAR <> trim(substr(x, 4, 3)) AND TRY_CAST(trim(substr(x, 7, 3)) AS INTEGER) BETWEEN 1 AND 4, false))) = m
  AND len(list_filter(l[5 + n + m:], lambda x: x NOT LIKE 'M  %')) = 0, false) AS valid FROM heads)"""


_FIELD = '"([^"]|"")*"|[^",]*'
_RAW = f"""
f AS (SELECT raw_id, file_name, received_at, CASE WHEN raw_line IS NULL THEN 'column_count' WHEN NOT regexp_full_match(raw_line, '(?s)({_FIELD})(,({_FIELD}))*') THEN 'quoting'
    WHEN len(regexp_extract_all(',' || raw_line, '(?s),({_FIELD})')) <> 10 THEN 'column_count' END AS broken,
  list_transform(regexp_extract_all(',' || raw_line, '(?s),({_FIELD})', 1), lambda x: CASE WHEN x LIKE '"%' THEN replace(substr(x, 2, len(x) - 2), '""', '"') ELSE x END) AS v FROM batch_raw),
g AS (SELECT raw_id, file_name, received_at, broken, {', '.join(f"CASE WHEN broken IS NULL THEN v[{i + 1}] END AS {c}" for i, c in enumerate(RAW_FIELDS))} FROM f)"""
_FINITE = lambda c: f"CASE WHEN regexp_full_match({c}, '[ \t]*{_NUMBER}[ \t]*') AND isfinite(TRY_CAST(trim(replace({c}, chr(9), ' ')) AS DOUBLE)) THEN CAST(trim(replace({c}, chr(9), ' ')) AS DOUBLE) END"
_WHOLE = lambda c: f"CASE WHEN regexp_full_match({c}, '[ \t]*[+-]?[0-9]+[ \t]*') THEN TRY_CAST(ltrim(trim(replace({c}, chr(9), ' ')), '+') AS INTEGER) END"
_TYPED = f"""{_RAW}, {valid_blocks('g', 'raw_id')},
t AS (SELECT raw_id, file_name, received_at, broken, SourceID, SMILES, {', '.join(f"{(_WHOLE if c in ('FormalCharge', 'Multiplicity') else _FINITE)(c)} AS {c}" for c in RAW_FIELDS[2:8])}, PartialCharges, mol_block, valid FROM g JOIN blocks USING (raw_id))"""
_REASONS = "list_filter(['energy', 'formal_charge', 'mol_block'], lambda r: CASE r WHEN 'energy' THEN NOT coalesce(isfinite(Energy_Ha), false) WHEN 'formal_charge' THEN FormalCharge IS NULL ELSE NOT valid END)"
_P2_RAW = f"WITH {_TYPED} SELECT 'batch_raw' AS origin, raw_id AS rec_id, unnest(CASE WHEN broken IS NOT NULL THEN [broken] ELSE {_REASONS} END) AS reason FROM t"
_P2_BATCH = f"WITH {valid_blocks('batch', 'row_seq')} SELECT 'batch' AS origin, row_seq AS rec_id, unnest({_REASONS}) AS reason FROM batch JOIN blocks USING (row_seq)"

QUERIES = {f.__name__: f for f in (p2_found, p2_loaded_raw, p2_loaded_batch, p2_edits, p4_found, p4_counts)}
SQL = {
    "p2_found": f"SELECT * FROM ({_P2_RAW}) UNION ALL SELECT * FROM ({_P2_BATCH})",
    "p2_loaded_raw": f"WITH {_TYPED} SELECT * EXCLUDE (broken, valid) FROM t WHERE broken IS NULL AND len({_REASONS}) = 0",
    "p2_loaded_batch": f"WITH {valid_blocks('batch', 'row_seq')} SELECT batch.* FROM batch JOIN blocks USING (row_seq) WHERE len({_REASONS}) = 0",
    "p4_found": _P4 + "SELECT * FROM f",
    "p4_counts": _P4 + "SELECT table_name, period, kind, count(*) AS molecules FROM f GROUP BY ALL",
}
