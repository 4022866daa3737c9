"""Rows that fail to parse: typed rows on one side, rejects with each reason on the other.

Delimited lines go through a minimum-cost error parse. A dynamic program over the structural characters of a line
(quotes and delimiters; runs of other characters count as one) may insert or delete a quote or a delimiter. Costs are
ordered: quote edits first, delimiter edits second, so that a delimiter edit never hides a broken quote. A line of cost
nothing is loaded, once its fields also have valid types; otherwise the kind of the cheapest edits is the reason.

With costs in this order the least number of quote edits is 0 exactly where the quoting is right as it stands, since a
delimiter may be inserted or deleted next to any field without touching its quotes: `quoting` then is what the delivery
means by it, "a field neither free of quotes nor wholly enclosed", and comes before `column_count`. A single weighted
cost would call some lines of broken quoting a column_count (one delimiter too many may cost less than two quotes). What
the program adds is the repair: `mended` applies the edits, and the line then parses at no cost.

The zero-cost path of the program is deterministic, so it is tried alone at first; only lines that leave it pay for
the full table (structural characters x 4 states x fields wanted, which is linear in the length of the line).
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corundum.functions.v2000 import block_valid, finite_number, whole_number

RAW_FIELDS = ("SourceID", "SMILES", "Energy_Ha", "FormalCharge", "Multiplicity", "HOMO_Ha", "LUMO_Ha", "HL_Gap_Ha", "PartialCharges", "mol_block")

START, BARE, QUOTED, CLOSED = range(4)
_FAR = (1 << 30, 0)


def exact_fields(line: str, delimiter: str = ",", quote: str = '"') -> list[str] | None:
    """Fields of a line whose quoting needs no edit, else None: the zero-cost path of the error parse."""
    fields, at, end = [], 0, len(line)
    while True:
        if line.startswith(quote, at):
            parts, at = [], at + 1
            while True:
                close = line.find(quote, at)
                if close < 0:
                    return None
                parts.append(line[at:close])
                at = close + 1
                if not line.startswith(quote, at):
                    break
                parts.append(quote)
                at += 1
            fields.append("".join(parts))
            if at < end and line[at] != delimiter:
                return None
        else:
            stop = line.find(delimiter, at)
            stop = end if stop < 0 else stop
            if line.find(quote, at, stop) >= 0:
                return None
            fields.append(line[at:stop])
            at = stop
        if at >= end:
            return fields
        at += 1


def _tokens(line: str, delimiter: str, quote: str) -> Iterator[tuple[str, int]]:
    """(kind, position): q, d, or t for a run of other characters."""
    run = False
    for i, c in enumerate(line):
        if c == quote or c == delimiter:
            yield ("q" if c == quote else "d"), i
            run = False
        elif not run:
            yield "t", i
            run = True


def least_edits(line: str, wanted: int, delimiter: str = ",", quote: str = '"') -> tuple[int, int, list[str]]:
    """(quote edits, delimiter edits, edits with their positions) of the cheapest repair of a line to `wanted` fields.

    Cells are (state, complete fields so far, at most wanted - 1); once all separators are there, a further one has to
    be deleted, and what is missing at the end is inserted there.
    """
    # cell: (quote edits, delimiter edits, linked list of edits)
    cells: dict[tuple[int, int], tuple[int, int, tuple | None]] = {(START, 0): (0, 0, None)}
    for kind, at in [*_tokens(line, delimiter, quote), ("end", len(line))]:
        # Insertions before this character: an opening quote, a closing quote, or the doubling of a closing one.
        for (state, n), (q, d, e) in list(cells.items()):
            into = {START: QUOTED, QUOTED: CLOSED, CLOSED: QUOTED}.get(state)
            if into is not None:
                _offer(cells, (into, n), q + 1, d, e, ("insert quote", at))
        if kind == "end":
            break
        after: dict[tuple[int, int], tuple[int, int, tuple | None]] = {}
        for (state, n), (q, d, e) in cells.items():
            if kind == "t":
                if state != CLOSED:
                    _offer(after, (BARE if state == START else state, n), q, d, e)
            elif kind == "q":
                if state != BARE:
                    _offer(after, ({START: QUOTED, QUOTED: CLOSED, CLOSED: QUOTED}[state], n), q, d, e)
                _offer(after, (state, n), q + 1, d, e, ("delete quote", at))
            elif state == QUOTED:
                _offer(after, (QUOTED, n), q, d, e)
            else:
                if n + 1 < wanted:
                    _offer(after, (START, n + 1), q, d, e)
                # Two fields become one, each part bare or enclosed as it was.
                _offer(after, (START, n), q, d + 1, e, ("delete delimiter", at))
        cells = after
    best = min(((q, d + wanted - 1 - n, wanted - 1 - n, e) for (state, n), (q, d, e) in cells.items() if state != QUOTED), key=lambda x: x[:3])
    edits: list[str] = []
    link = best[3]
    while link:
        link, (what, at) = link
        edits.append(f"{what} at {at}")
    return best[0], best[1], [*reversed(edits), *[f"insert delimiter at {len(line)}"] * best[2]]


def _offer(cells: dict, key: tuple[int, int], q: int, d: int, edits: tuple | None, new: tuple | None = None) -> None:
    have = cells.get(key)
    if have is None or (q, d) < have[:2]:
        cells[key] = (q, d, (edits, new) if new else edits)


def mended(line: str, edits: list[str], delimiter: str = ",", quote: str = '"') -> str:
    """The line with its edits done; positions are those of the line as it came.

    Quotes go in and out where the edits say. A deleted delimiter makes two fields one: their values are joined, and the
    field is enclosed anew where its value needs it.
    """
    gone, put, joined, added = set(), {}, set(), 0
    for edit in edits:
        what, sign, _, at = edit.split(" ")
        if sign == "delimiter":
            added += what == "insert"
            joined |= {int(at)} if what == "delete" else set()
        elif what == "delete":
            gone.add(int(at))
        else:
            put[int(at)] = put.get(int(at), 0) + 1
    signs = [(quote if k else line[i], i) for i in range(len(line) + 1) for k in range(put.get(i, 0), -1, -1) if k or (i < len(line) and i not in gone)]
    fields, part, inside, glued = [], [], False, False

    def close() -> None:
        text = "".join(part)
        value = text[1:-1].replace(quote * 2, quote) if text.startswith(quote) else text
        if glued:
            fields[-1] += value
        else:
            fields.append(value)

    for c, i in signs:
        if c == delimiter and not inside:
            close()
            part, glued = [], i in joined
        else:
            inside ^= c == quote
            part.append(c)
    close()
    shown = [quote + f.replace(quote, quote * 2) + quote if any(x in f for x in (quote, delimiter, "\n", "\r")) else f for f in fields]
    return delimiter.join([*shown, *[""] * added])


def parse_line(line: str | None, wanted: int, delimiter: str = ",", quote: str = '"') -> tuple[list[str] | None, str | None, str | None]:
    """(fields, reason, edits): fields of a zero-cost line, else the reason and all of the cheapest edits.

    A null line has no field at all and is a column_count case.
    """
    if line is None:
        return None, "column_count", f"insert {wanted} fields"
    fields = exact_fields(line, delimiter, quote)
    if fields is not None and len(fields) == wanted:
        return fields, None, None
    quotes, _, edits = least_edits(line, wanted, delimiter, quote)
    return None, "quoting" if quotes else "column_count", "; ".join(edits)


def parse_delimited(df: DataFrame, line: str, keys: list[str], fields: tuple[str, ...], delimiter: str = ",", quote: str = '"') -> DataFrame:
    """Keys, one string column for each field (null in a failed line), line_reason, line_edits and line_mended."""
    source = df.select(*keys, F.col(line).alias("_line"))
    schema = pa.schema([*[pa.field(f, pa.string()) for f in fields], pa.field("line_reason", pa.string()), pa.field("line_edits", pa.string()), pa.field("line_mended", pa.string())])
    kept = len(keys)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            for text in batch.column(kept):
                line = text.as_py()
                got, reason, edits = parse_line(line, len(fields), delimiter, quote)
                repaired = mended(line, edits.split("; "), delimiter, quote) if edits and line is not None else None
                for col, value in zip(out, [*(got or [None] * len(fields)), reason, edits, repaired], strict=True):
                    col.append(value)
            arrays = [pa.array(v, f.type) for v, f in zip(out, schema, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:kept], *arrays], names=[*keys, *schema.names])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:kept])
    return source.mapInArrow(parse, types + "".join(f", `{f}` string" for f in schema.names))


def _with_reasons(df: DataFrame, tests: dict, line_reason: bool = False) -> DataFrame:
    found = F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in tests.items()]), lambda r: r.isNotNull())
    if line_reason:
        found = F.when(F.col("line_reason").isNotNull(), F.array("line_reason")).otherwise(found)
    return df.withColumn("reasons", found)


def judge_raw(raw: DataFrame) -> DataFrame:
    """Every delivered line with typed fields (null where unusable), `reasons` (empty: it loads), line_edits and line_mended.

    For a line the first of quoting and column_count that applies stands alone; otherwise energy, formal_charge and
    mol_block are judged each by themselves. Empty table: no rows.
    """
    parsed = parse_delimited(raw, "raw_line", ["raw_id", "file_name", "received_at"], RAW_FIELDS)
    typed = parsed.withColumns({"__block": block_valid("mol_block"), "__energy": finite_number(F.col("Energy_Ha")), "__charge": whole_number(F.col("FormalCharge"))})
    tests = {"energy": F.col("__energy").isNull(), "formal_charge": F.col("__charge").isNull(), "mol_block": ~F.col("__block")}
    judged = _with_reasons(typed, tests, line_reason=True)
    return judged.select(
        "raw_id", "file_name", "received_at", "SourceID", "SMILES", F.col("__energy").alias("Energy_Ha"), F.col("__charge").alias("FormalCharge"),
        whole_number(F.col("Multiplicity")).alias("Multiplicity"), *[finite_number(F.col(c)).alias(c) for c in ("HOMO_Ha", "LUMO_Ha", "HL_Gap_Ha")],
        "PartialCharges", F.when(F.col("__block"), F.col("mol_block")).alias("mol_block"), "reasons", "line_edits", "line_mended",
    )


def judge_batch(batch: DataFrame) -> DataFrame:
    """Every batch record with `reasons`; null, NaN and infinite energies, null charges and unusable blocks are the cases."""
    e = F.col("Energy_Ha")
    bad = e.isNull() | F.isnan(e) | e.isin(float("inf"), float("-inf"))
    tests = {"energy": F.coalesce(bad, F.lit(True)), "formal_charge": F.col("FormalCharge").isNull(), "mol_block": ~F.col("__block")}
    return _with_reasons(batch.withColumn("__block", block_valid("mol_block")), tests).drop("__block")


def loaded(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("reasons") == 0).drop("reasons", "line_edits", "line_mended")


def rejects(judged: DataFrame, rec_id: str, origin: str) -> DataFrame:
    """One row for each record and reason: origin, rec_id, reason."""
    # explode_outer: plain explode would have a filter on the reasons pushed down, which judges every row twice.
    reasons = judged.select(F.lit(origin).alias("origin"), F.col(rec_id).alias("rec_id"), F.explode_outer("reasons").alias("reason"))
    return reasons.filter("reason is not null")
