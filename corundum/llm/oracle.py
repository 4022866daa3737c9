"""SQL for DuckDB of those queries that SQL can express."""

_COMPOUND = """
WITH k AS (SELECT *, lower(regexp_replace(CompoundID, '[-{}\\s]', '', 'g')) AS h FROM batch),
c AS (SELECT *, CASE WHEN regexp_matches(h, '^[0-9a-f]{32}$') THEN h WHEN trim(CanonicalSMILES) <> '' THEN md5(CanonicalSMILES) END AS compound_id FROM k),
g AS (SELECT * FROM c WHERE compound_id IN (SELECT compound_id FROM c GROUP BY 1 HAVING count(*) >= 2))
"""

_ORDER = """ORDER BY CASE lower(regexp_replace(dedup_status, '[-_\\s]', '', 'g')) WHEN 'ok' THEN 0 WHEN 'conformerduplicate' THEN 1
  WHEN 'bondassignmentfailed' THEN 2 WHEN 'molcorrupt' THEN 3 ELSE 4 END, loaded_at DESC NULLS LAST, row_seq"""


def _supplier(field: str, usable: str) -> str:
    return f"SELECT compound_id, '{field}' AS field_name, first(row_seq {_ORDER}) AS row_seq FROM g WHERE {usable} GROUP BY 1"


_NUMBERS = [(f, f"isfinite({f})") for f in ("Energy_Ha", "HOMO_Ha", "LUMO_Ha")]

_BOUNDS = " UNION ALL ".join(
    f"SELECT '{name}' AS grouping, CAST({key} AS VARCHAR) AS group_key, '{metric}' AS metric, count(*) AS n, true AS certified FROM batch WHERE {usable} GROUP BY 2"
    for name, key in (("family", "family"), ("batch_file", "batch_file"), ("day", "CAST(loaded_at AS DATE)"))
    for metric, usable in (("Energy_Ha", "isfinite(Energy_Ha)"), ("num_atoms", "num_atoms IS NOT NULL"))
)

# The plan of the splits: the running share of rows over each stride and turn of the ring, and the arcs nearest to the targets.
_SPLITS = _COMPOUND + """, i AS (SELECT row_seq, compound_id, coalesce('compound:' || compound_id, 'row:' || row_seq) AS component_id FROM c),
h AS (SELECT *, CAST('0x' || substr(md5('17:' || component_id), 1, 4) AS INTEGER) AS b FROM i),
m AS (SELECT b, count(*) AS n FROM h GROUP BY 1), w AS (SELECT sum(n) AS total FROM m),
t AS (SELECT split_name, share / (SELECT sum(share) FROM split_targets WHERE share > 0) AS share FROM split_targets WHERE share > 0),
u AS (SELECT split_name, share, sum(share) OVER (ORDER BY split_name) AS upto, row_number() OVER (ORDER BY split_name) - 1 AS k FROM t),
p AS (SELECT stride, turn, b, n, (b * stride + turn * 1024) % 65536 AS place FROM m, range(1, 32, 2) s(stride), range(64) r(turn)),
q AS (SELECT *, (sum(n) OVER (PARTITION BY stride, turn ORDER BY place) - n / 2) / total AS middle FROM p, w),
a AS (SELECT stride, turn, b, n, least((SELECT count(*) FROM u WHERE upto <= middle), (SELECT max(k) FROM u)) AS k FROM q),
v AS (SELECT stride, turn, k, sum(n) AS n FROM a GROUP BY ALL),
d AS (SELECT stride, turn, max(abs(coalesce(v.n, 0) / total - share)) AS off FROM (SELECT DISTINCT stride, turn FROM p) CROSS JOIN u CROSS JOIN w LEFT JOIN v USING (stride, turn, k) GROUP BY ALL),
o AS (SELECT stride, turn FROM d ORDER BY off, stride, turn LIMIT 1),
x AS (SELECT h.row_seq, h.compound_id, h.component_id, split_name FROM h JOIN a USING (b) JOIN o USING (stride, turn) JOIN u USING (k))
"""

_FIRST = lambda value, usable: f"first({value} {_ORDER}) FILTER ({usable})"
_USABLE = [*_NUMBERS, ("PartialCharges", "regexp_matches(PartialCharges, '\\S')")]
_SURVIVORS = _COMPOUND + f"""SELECT compound_id, records, base_row_seq, {', '.join(f for f, _ in _USABLE)}, CAST({' + '.join(f'coalesce(CAST(by_{f} <> base_row_seq AS INTEGER), 0)' for f, _ in _USABLE)} AS INTEGER) AS filled_from_others
FROM (SELECT compound_id, count(*) AS records, first(row_seq {_ORDER}) AS base_row_seq, {', '.join(f"{_FIRST(f, u)} AS {f}, {_FIRST('row_seq', u)} AS by_{f}" for f, u in _USABLE)} FROM g GROUP BY 1)"""

SQL = {
    "p1_splits": _SPLITS + "SELECT * FROM x",
    "p1_shares": _SPLITS + ", y AS (SELECT split_name, count(*) AS n, count(DISTINCT component_id) AS c FROM x GROUP BY 1) SELECT split_name, split_targets.share, n AS rows, c AS components, n / (SELECT total FROM w) AS reached FROM split_targets LEFT JOIN y USING (split_name)",
    "p5_survivors": _SURVIVORS,
    "p1_found": _COMPOUND + "SELECT row_seq, compound_id FROM g",
    "p3_bounds": _BOUNDS,
    "p5_found": _COMPOUND + " UNION ALL ".join(_supplier(*x) for x in [*_NUMBERS, ("PartialCharges", "regexp_matches(PartialCharges, '\\S')")]),
}
