import random
import re
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corundum.functions.v2000 import is_block
from corundum.operators.parse_errors import exact_fields, judge_batch, judge_raw, least_edits, loaded, mended, parse_line, rejects

GOOD = "t\n  p\n\n  2  1  0  0  0  0  0  0  0  0999 V2000\n    0.0000    1.0000   -1.5000 C   0  0\n    1.0000    1.0e0     2.0000 Cl  0  0\n  1  2  1  0\nM  END"


def by_rule(line):
    """Fields by the rule's words: split at delimiters outside quotes, every field bare or wholly enclosed."""
    fields, at = [], 0
    while True:
        m = re.compile(r'"((?:[^"]|"")*)"|([^",]*)').match(line, at)
        fields.append(m[1].replace('""', '"') if m[1] is not None else m[2])
        at = m.end()
        if at == len(line):
            return fields
        if line[at] != ",":
            return None
        at += 1


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet='a",\n ', max_size=14), st.integers(1, 5))
def test_error_parse_agrees_with_the_rule(line, wanted):
    rule = by_rule(line)
    assert exact_fields(line) == rule
    quotes, delimiters, edits = least_edits(line, wanted)
    assert (quotes == 0) == (rule is not None)
    assert len(edits) == quotes + delimiters
    if rule is not None:
        assert delimiters == abs(len(rule) - wanted)
        assert ((quotes, delimiters) == (0, 0)) == (len(rule) == wanted)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet='a",', max_size=6), st.integers(1, 3))
def test_quote_edits_are_least(line, wanted):
    """Breadth-first over insertions and deletions of quotes finds no well-formed line any nearer."""
    near, n = {line}, 0
    while not any(by_rule(x) is not None for x in near):
        near = {x[:i] + '"' + x[i:] for x in near for i in range(len(x) + 1)} | {x[:i] + x[i + 1 :] for x in near for i, c in enumerate(x) if c == '"'}
        n += 1
    assert least_edits(line, wanted)[0] <= n


def test_a_very_long_line_stays_linear():
    line = "," * 20_000 + '"x'
    assert parse_line(line, 10)[1] == "quoting"
    assert parse_line(None, 10)[1] == "column_count"
    assert parse_line("", 1) == ([""], None, None)


@pytest.mark.parametrize(
    ("block", "good"),
    [
        (GOOD, True), (GOOD + "\n\r\n", True), (GOOD.replace("\n", "\r\n"), True), (None, False), ("", False),
        (GOOD.replace("V2000", "V3000"), False), (GOOD.replace("  1  2  1", "  1  1  1"), False), (GOOD.replace("  1  2  1", "  1  3  1"), False), (GOOD.replace("  1  2  1", "  1  2  5"), False),
        (GOOD.replace("Cl ", "Xx "), False), (GOOD.replace("1.0e0 ", "1.0e999"), False), (GOOD.replace("   -1.5000", "       nan"), False), (GOOD.replace("  2  1  0", "  3  1  0"), False),
        (GOOD + "\nx", False), (GOOD.replace("M  END", "M  CHG  1   1   1\nM  END"), True), (GOOD.replace("M  END", ""), False), (GOOD.replace("  1  2  1", "  1 +2  1"), False), (GOOD.replace("1.0e0 ", "1_0.0 "), False),
    ],
)
def test_blocks(block, good):
    assert is_block(block) is good


def line(energy="-1.5", charge="0", block=GOOD, more=""):
    return f'S1,CC,{energy},{charge},1,,,,,"{block}"{more}'


def test_raw_lines(spark):
    now = datetime(2024, 1, 1)
    cases = {
        1: line(), 2: line(" +1e-3 ", ' "0"'), 3: line(energy="1e999"), 4: line(energy="1,5"), 5: line(charge="1.0", block="x"), 6: None, 7: "", 8: line(more="x"), 9: line(charge="99999999999"),
        10: line(energy="１"), 11: line(energy="nan", charge="", block=""), 12: line(charge="-0"),
    }
    raw = spark.createDataFrame([(i, x, "f", now, "extra") for i, x in cases.items()], "raw_id bigint, raw_line string, file_name string, received_at timestamp_ntz, reasons string")
    judged = judge_raw(raw).cache()
    found = {(r["rec_id"], r["reason"]) for r in rejects(judged, "raw_id", "batch_raw").collect()}
    assert found == {(2, "quoting"), (3, "energy"), (4, "column_count"), (5, "formal_charge"), (5, "mol_block"), (6, "column_count"), (7, "column_count"), (8, "quoting"), (9, "formal_charge"), (10, "energy"), (11, "energy"), (11, "formal_charge"), (11, "mol_block")}
    good = {r["raw_id"]: r for r in loaded(judged).collect()}
    assert set(good) == {1, 12} and good[1]["Energy_Ha"] == -1.5 and good[1]["mol_block"] == GOOD and good[1]["HOMO_Ha"] is None
    assert judge_raw(raw.limit(0)).count() == 0


def test_batch_records(spark):
    rows = [(1, 1.0, 0, GOOD), (2, None, 0, GOOD), (3, float("nan"), None, None), (4, float("inf"), 1, "x"), (4, float("inf"), 1, "x")]
    judged = judge_batch(spark.createDataFrame(rows, "row_seq bigint, Energy_Ha double, FormalCharge int, mol_block string"))
    found = sorted((r["rec_id"], r["reason"]) for r in rejects(judged, "row_seq", "batch").collect())
    assert found == [(2, "energy"), (3, "energy"), (3, "formal_charge"), (3, "mol_block"), (4, "energy"), (4, "energy"), (4, "mol_block"), (4, "mol_block")]
    assert [r["row_seq"] for r in loaded(judged).collect()] == [1]


def test_all_edits_of_a_long_line_are_shown():
    line = 'a"' * 130
    _, reason, shown = parse_line(line, 10)
    edits = least_edits(line, 10)[2]
    assert reason == "quoting" and len(edits) > 100 and shown.split("; ") == edits


def test_mended_lines_parse_at_no_cost():
    rng = random.Random(8)
    for _ in range(3000):
        line, wanted = "".join(rng.choice('",,ab"\n') for _ in range(rng.randrange(14))), rng.randrange(1, 6)
        quotes, delimiters, edits = least_edits(line, wanted)
        assert len(edits) == quotes + delimiters
        fields = exact_fields(mended(line, edits))
        assert fields is not None and len(fields) == wanted, (line, edits, mended(line, edits))
        # What the module states of its order of costs.
        assert (quotes == 0) == (exact_fields(line) is not None)


def test_mended_column(spark):
    df = spark.createDataFrame([(1, "f", None, 'a"b,c'), (2, "f", None, None)], "raw_id bigint, file_name string, received_at timestamp, raw_line string")
    got = {r["raw_id"]: (r["reasons"], r["line_mended"]) for r in judge_raw(df).collect()}
    assert got[1][0] == ["quoting"] and len(exact_fields(got[1][1])) == 10 and got[2] == (["column_count"], None)
