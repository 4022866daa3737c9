import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corundum.functions import chem
from corundum.functions.arrow import fixed_text, number_text
from corundum.operators import assemble, chemfilter, contract, dedup, energy, similarity, stats
from corundum.operators.medians import exact_median
from corundum.plans import curation, pipeline
from tests.test_parse_errors import GOOD

SMILES = ["CCO", "N[C@@H](C)C(=O)O", "C1=CC=NC=C1", "c1ccc2ccccc2c1", "C[N+](C)(C)CC(=O)[O-]", "OP(=O)(O)O", "FC(F)(F)C1CC1", "CS(=O)(=O)C", "CC.O", "O=C(C)Oc1ccccc1C(=O)O"]


def shuffled(mol, rng):
    n = len(mol.atoms)
    new = list(range(n))
    rng.shuffle(new)
    atoms = [None] * n
    for i, a in enumerate(mol.atoms):
        atoms[new[i]] = chem.replace(a, around=[x if x < 0 else new[x] for x in a.around])
    return chem.Molecule(atoms, {(min(new[a], new[b]), max(new[a], new[b])): o for (a, b), o in mol.bonds.items()})


@pytest.mark.parametrize("text", SMILES)
def test_canonical_text_does_not_depend_on_the_order(text):
    rng, mol = random.Random(1), chem.parse_smiles(text)
    once = chem.write_smiles(mol)
    assert chem.write_smiles(chem.parse_smiles(once)) == once
    assert all(chem.write_smiles(shuffled(mol, rng)) == once for _ in range(10))
    assert chem.write_smiles(chem.mirror(chem.mirror(mol))) == once


def test_equal_molecules_written_differently():
    same = lambda *texts: len({chem.write_smiles(chem.parse_smiles(t)) for t in texts}) == 1
    assert same("C1=CC=CC=C1", "c1ccccc1", "C=1C=CC=CC1")
    assert same("N[C@@H](C)C(=O)O", "C[C@H](N)C(O)=O", "OC(=O)[C@@H](N)C")
    assert not same("N[C@@H](C)C(=O)O", "N[C@H](C)C(=O)O")
    assert same("OCC", "C(O)C")


def test_charges_radicals_and_descriptors():
    facts = lambda s: chem.smiles_facts(s)
    assert facts("C[N+](C)(C)C")[4:7] == (1, 1, 0) and facts("[NH3+]CC(=O)[O-]")[4:7] == (0, 2, 0) and facts("[CH3]")[6] == 1 and facts("C[CH]C")[6] == 1
    assert facts("CC(=O)Oc1ccccc1C(=O)O")[8] == pytest.approx(180.16, abs=0.02) and facts("CC(=O)Oc1ccccc1C(=O)O")[9] == pytest.approx(63.60)
    assert facts("CCO.CC")[7] == 2 and facts("") is not None
    for bad in ("C(", "C1CC", "[Xx]", "C)", "C==C", "=C", "C%1", "1C"):
        assert chem.parse_smiles(bad) is None, bad
    assert chem.parse_smiles(None) is None


def test_reordered_block_is_the_same_molecule_in_one_order():
    mol = chem.parse_block(GOOD)
    again = chem.reorder_block(GOOD)
    assert chem.write_smiles(chem.parse_block(again)) == chem.write_smiles(mol) and chem.reorder_block(again) == again
    assert chem.reorder_block("x") is None and chem.reorder_block(None) is None


def test_fit_equals_least_squares(spark):
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 9, (300, 4))
    counts[:, 3] = counts[:, 2]  # collinear: the least-norm answer shares the coefficient
    y = counts @ np.array([-0.5, -37.0, -10.0, -10.0]) + rng.normal(0, 0.1, 300)
    y[5] += 50
    rows = [(i, *map(int, c), float(v)) for i, (c, v) in enumerate(zip(counts, y, strict=True))] + [(900, 1, 1, 1, 1, None), (901, 1, 1, 1, 1, float("nan")), (902, 1, 1, 1, 1, float("inf"))]
    df = spark.createDataFrame(rows, "id int, n_a int, n_b int, n_c int, n_d int, e double")
    done, beta = energy.flag_outliers(df, ["n_a", "n_b", "n_c", "n_d"], "e")
    want = np.linalg.lstsq(counts.astype(float), y, rcond=None)[0]
    assert np.allclose(list(beta.values()), want, atol=1e-6)
    res = y - counts @ want
    z = 0.6745 * (res - np.median(res)) / np.median(np.abs(res - np.median(res)))
    got = {r["id"]: r for r in done.collect()}
    assert np.allclose([got[i]["z_residual"] for i in range(300)], z, atol=1e-4)
    assert {got[i]["energy_status"] for i in (900, 901, 902)} == {"energy_nonfinite"} and got[5]["energy_status"] == "flagged"
    same = spark.createDataFrame([(i, 1, 2.0) for i in range(5)], "id int, n_a int, e double")
    assert {r["energy_status"] for r in energy.flag_outliers(same, ["n_a"], "e")[0].collect()} == {"ok"}
    assert energy.flag_outliers(same.limit(0), ["n_a"], "e")[0].count() == 0


@pytest.mark.parametrize("values", [[], [3.0], [1.0, 2.0], [5.0] * 9, [1e300, -1e300, 0.0], [1.0, float("nan"), None, float("inf"), 4.0], np.random.default_rng(2).standard_cauchy(5001).tolist(), [0.0] * 500 + [1e9]])
def test_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    finite = [v for v in values if v is not None and np.isfinite(v)]
    got = exact_median(df, df["v"])
    assert got is None if not finite else got == pytest.approx(np.median(finite), rel=1e-15)


def test_first_occurrence_with_a_hot_key(spark):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 11}", i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "row_seq bigint, key string, _first int")
    seen, want = set(), {}
    for i, k, _ in rows:
        want[i] = None if k is None else "conformer_duplicate" if k in seen else "ok"
        seen.add(k)
    got = {r["row_seq"]: r for r in dedup.first_occurrence(df, "key", "row_seq").collect()}
    assert {i: r["dedup_status"] for i, r in got.items()} == want
    assert all((r["ICONF"] == 1) == (r["dedup_status"] == "ok") for r in got.values())
    assert dedup.first_occurrence(df.limit(0), "key", "row_seq").count() == 0
    late = dedup.first_occurrence(df, "key", "row_seq", df["row_seq"] > 0)
    assert late.filter("row_seq = 0").first()["dedup_status"] is None and late.filter("row_seq = 3").first()["dedup_status"] == "ok"


def test_mirror_removal_equals_the_pairwise_loop(spark):
    rng = random.Random(3)
    for _ in range(3):
        forms = [rng.choice(["ab", "ba", "cc", "de", "ed", None]) for _ in range(40)]
        kept, want = [], {}
        removed = set()
        for i, s in enumerate(forms):
            want[i] = "kept"
        for i, s in enumerate(forms):
            if s is None or i in removed:
                continue
            for j in range(i + 1, len(forms)):
                if forms[j] is not None and j not in removed and forms[j] == s[::-1]:
                    removed.add(j)
        for j in removed:
            want[j] = "removed_enantiomer"
        df = spark.createDataFrame(list(enumerate(forms)), "row_seq bigint, s string")
        from pyspark.sql import functions as F

        got = {r["row_seq"]: r["stereo_status"] for r in dedup.mirror_removal(df, F.col("s"), F.reverse("s"), "row_seq").collect()}
        assert got == want, (forms, kept)


def test_contract(spark):
    names = ["Energy_Ha", "FormalCharge", "Multiplicity", "SMILES", "SourceID", "HOMO_Ha", "LUMO_Ha", "HL_Gap_Ha", "PartialCharges"]
    row = lambda **k: tuple({"Energy_Ha": "-1.5", "FormalCharge": "0", "Multiplicity": "1", "SMILES": "C", "SourceID": "s", "HOMO_Ha": "1", "LUMO_Ha": "1", "HL_Gap_Ha": "1", "PartialCharges": "0"} | k for _ in [0])[0]
    cases = [({}, 0), ({"Energy_Ha": None}, 1), ({"Energy_Ha": "nan"}, 0), ({"Energy_Ha": "1.0d"}, 1), ({"Energy_Ha": "1_0"}, 0), ({"Multiplicity": "0"}, 1), ({"Multiplicity": "-1"}, 1), ({"Multiplicity": "1.5"}, 1), ({"FormalCharge": "+1"}, 0), ({"FormalCharge": "abc"}, 1), ({"HOMO_Ha": "x"}, 1), ({"SMILES": None}, 0)]
    df = spark.createDataFrame([(i, *(row(**c)[n] for n in names)) for i, (c, _) in enumerate(cases)], "id int, " + ", ".join(f"{n} string" for n in names))
    got = {r["id"]: r for r in contract.validate_contract(df).collect()}
    assert [len(got[i]["errors"]) for i in range(len(cases))] == [n for _, n in cases]
    assert got[11]["warnings"] == ["SMILES: missing (recommended)"]
    lenient = {r["id"]: r["passed"] for r in contract.validate_contract(df, strict=False).collect()}
    assert lenient[1] and not lenient[3]


def test_number_text(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (-12345678.9,), (0.0001,), (None,)], "v double")
    assert [r[0] for r in df.select(fixed_text(2)("v")).collect()] == ["0.12", "2.50", "-12345678.90", "0.00", None]
    assert [r[0] for r in df.select(number_text("v")).collect()] == ["0.125", "2.5", "-12345678.9", "0.0001", None]


def test_statistics(spark):
    values = np.random.default_rng(4).normal(size=500).tolist() + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r["rows"] for r in stats.histogram(df, "v").orderBy("bin").collect()] == np.histogram([v for v in values[:500]], 50)[0].tolist()
    assert stats.histogram(df.limit(0), "v").count() == 0
    assert sum(r["rows"] for r in stats.histogram(spark.createDataFrame([(2.0,)] * 4, "v double"), "v").collect()) == 4
    empty = stats.describe(df.limit(0), ["v"]).first()
    assert empty["n"] == 0 and empty["median"] is None
    assert {r["share"] for r in stats.range_buckets(spark.createDataFrame([], "n int"), "n").collect()} == {None}


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(6)
    words = rng.integers(-(2**62), 2**62, (130, 2)) & rng.integers(-(2**62), 2**62, (130, 2))
    words[7] = words[40]
    words[3] = 0
    df = spark.createDataFrame([(i, [int(x) for x in w]) for i, w in enumerate(words)] + [(500, None)], "id bigint, bits array<bigint>").repartition(5)
    bits = lambda w: {(k, b) for k, x in enumerate(w) for b in range(64) if int(x) >> b & 1}
    sets = [bits(w) for w in words]
    sim = lambda a, b: len(a & b) / len(a | b) if a | b else 0.0
    want = {i: max(sim(sets[i], s) for j, s in enumerate(sets) if j != i) for i in range(0, 130, 20)}
    got = {r["query_id"]: r["max_tanimoto"] for r in similarity.nearest_neighbours(df, "id", "bits", block=3).collect()}
    assert got == pytest.approx(want) and got[40] == 1.0
    assert similarity.nearest_neighbours(df.limit(0), "id", "bits").count() == 0


def test_formal_charge_ties_to_even(spark):
    df = spark.createDataFrame([(1, [0.25, 0.25]), (2, [0.75, 0.75]), (3, [None, 1.0]), (4, [float("nan")]), (5, [-0.6])], "i int, q array<double>")
    assert [r[0] for r in df.orderBy("i").select(assemble.formal_charge(df["q"])).collect()] == [0, 2, None, None, -1]


def test_filter_options_and_pipeline(spark):
    base = [(i, b, 0, 1, f"s{i}", -40.0 * i, "C") for i, b in enumerate([GOOD, GOOD, None, "x"])]
    df = spark.createDataFrame(base, "row_seq bigint, mol_block string, FormalCharge int, Multiplicity int, SourceID string, Energy_Ha double, SMILES string").selectExpr("*", "2 as num_atoms", "1 as num_bonds")
    assert [r["filter_reason"] for r in chemfilter.filter_blocks(df, "none", elements=("C",)).orderBy("row_seq").collect()] == ["element", "element", "could not parse mol_block", "could not parse mol_block"]
    assert chemfilter.filter_blocks(df, "none", heavy=(3, 9)).filter("filter_reason = 'heavy_atoms=2'").count() == 2
    tagged = pipeline.curate(df).cache()
    assert tagged.count() == 4 and tagged.filter("dedup_status = 'mol_corrupt'").count() == 2
    assert pipeline.curate(df, pipeline.Options(on_reject="drop", preset="none")).count() <= 2
    assert pipeline.stage_report(tagged).count() > 0 and pipeline.failed(tagged)
    assert pipeline.rejects_by_stage(tagged).filter("stage = 'energy'").count() == 2


def geometry(atoms):
    lines = [f"{x:10.4f}{y:10.4f}{z:10.4f} {s:<3s} 0  0" for s, x, y, z in atoms]
    return "\n".join(["t", "", "", f"{len(atoms):3d}  0  0  0  0  0  0  0  0  0999 V2000", *lines, "M  END"])


def test_bonds_from_geometry():
    ethene = geometry([("C", 0, 0, 0), ("C", 1.33, 0, 0), ("H", -0.55, 0.93, 0), ("H", -0.55, -0.93, 0), ("H", 1.88, 0.93, 0), ("H", 1.88, -0.93, 0)])
    mol = chem.bonds_from_geometry(ethene)
    assert mol.bonds[(0, 1)] == 2 and len(mol.bonds) == 5 and chem.radicals(mol) == 0
    cyanide = geometry([("H", -1.06, 0, 0), ("C", 0, 0, 0), ("N", 1.16, 0, 0)])
    assert chem.bonds_from_geometry(cyanide).bonds == {(0, 1): 1.0, (1, 2): 3.0}
    hydroxide = geometry([("O", 0, 0, 0), ("H", 0.96, 0, 0)])
    assert chem.charges(chem.bonds_from_geometry(hydroxide, -1)) == (-1, 1) and chem.bonds_from_geometry(hydroxide, 1) is None
    methyl = geometry([("C", 0, 0, 0), ("H", 1.09, 0, 0), ("H", -0.55, 0.94, 0), ("H", -0.55, -0.94, 0)])
    assert chem.radicals(chem.bonds_from_geometry(methyl)) == 1
    assert chem.bonds_from_geometry(geometry([("Fe", 0, 0, 0)])) is None and chem.bonds_from_geometry(None) is None


def test_every_row_divisible_by_twenty_asks_its_structure(spark, tmp_path):
    forms = ["CCO", "CCN", "CCCO", "c1ccccc1O", "CC(=O)O", None, "", "C("]
    # Each structure comes first in a row that isn't divisible by 20; a later one that is repeats it.
    rows = [(1 + i, s) for i, s in enumerate(forms)] + [(20 * (i + 2), s) for i, s in enumerate(forms)] + [(20 * (i + 10), "CCO") for i in range(3)] + [(401, "CCCCO")]
    spark.createDataFrame(rows, "row_seq bigint, CanonicalSMILES string").write.parquet(f"{tmp_path}/batch.parquet")
    bits = lambda s: {64 * k + b for k, w in enumerate(chem.fingerprint(chem.parse_smiles(s))) for b in range(64) if w >> b & 1}
    sets = {s: bits(s) for s in {*forms[:5], "CCCCO"}}
    best = {s: max(len(a & b) / len(a | b) for t, b in sets.items() if t != s) for s, a in sets.items()}
    want = {i: best[s] for i, s in rows if i % 20 == 0 and s in best}
    got = curation.nearest_structures(spark, str(tmp_path)).collect()
    assert {r["query_id"]: r["max_tanimoto"] for r in got} == pytest.approx(want) and len(got) == len(want) == 8


def test_full_integrity_against_brute_force(spark, tmp_path):
    import hashlib

    lines = GOOD.split("\n")
    cut = lambda n: "\n".join(lines[:n])
    first, bond = lines[4], next(i for i in range(len(lines)) if lines[i].startswith("M  ")) - 1
    own = chem.write_smiles(chem._aromatize(chem.without_hydrogens(chem.parse_block(GOOD))), isomeric=False)
    n, m = int(lines[3][:3]), int(lines[3][3:6])
    whole = {
        "good": GOOD, "cut in an atom line": cut(4) + "\n" + first[:20], "no end": cut(len(lines) - 1) if lines[-1].startswith("M  END") else cut(len(lines) - 2),
        "bad number": GOOD.replace(first[:10], "   x.00000", 1), "bad element": GOOD.replace(first, first[:31] + "Qq " + first[34:], 1),
        "bad bond": GOOD.replace(lines[bond], "  1  1" + lines[bond][6:], 1), "no counts": "x", "null": None,
    }
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    rows, want = [], {}
    for name, block in whole.items():
        for text in (own, "C#CC#CBr", "C(", None, ""):
            for cid, e, atoms in ((md5(text or ""), -1.0, n), ("0" * 32, -1.0, n), (None, float("nan"), n), (None, -1.0, n + 1)):
                errors = [] if name == "good" else ["mol_block: could not parse"]
                if name == "good":
                    errors += [f"num_atoms mismatch: stored={atoms}, mol={n}"] * (atoms != n) + [f"CanonicalSMILES mismatch: stored={text}, recomputed={own}"] * (text in ("C#CC#CBr", "C("))
                    errors += ["Energy_Ha: not finite"] * (e != e) + [f"CompoundID mismatch: stored={cid}, recomputed={md5(text or "")}"] * bool(cid and text and cid != md5(text))
                want[len(rows)] = "; ".join(errors) or None
                rows.append((len(rows), block, atoms, m, text, cid, e))
    spark.createDataFrame(rows, "row_seq bigint, mol_block string, num_atoms int, num_bonds int, CanonicalSMILES string, CompoundID string, Energy_Ha double").write.parquet(f"{tmp_path}/batch.parquet")
    got = {r["row_seq"]: r for r in curation.QUERIES["integrity_full"](spark, str(tmp_path)).collect()}
    assert {i: r["validate_errors"] for i, r in got.items()} == want
    assert all((r["validate_status"] == "ok") == (want[i] is None) for i, r in got.items())


def test_frames_of_every_readable_block(spark, tmp_path):
    statuses = [("ok", "ok", "ok"), ("flagged", "ok", "ok"), (None, None, None), ("ok", "rejected", "invalid")]
    blocks = [GOOD, GOOD.replace("M  END", ""), GOOD[:120], "x", None]
    rows = [(10 * i + j, b, "s", "c", 0, 1, -1.0, "CCl", 1, *s) for i, b in enumerate(blocks) for j, s in enumerate(statuses)]
    schema = "row_seq bigint, mol_block string, SourceID string, CompoundID string, FormalCharge int, Multiplicity int, Energy_Ha double, CanonicalSMILES string, ICONF int, energy_status string, filter_status string, validate_status string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/batch.parquet")
    assert sorted(r["row_seq"] for r in curation.frame_export(spark, str(tmp_path)).collect()) == [0, 1, 2, 3]


def test_pipeline_takes_bonds_from_geometry(spark):
    atoms = [("C", 0, 0, 0), ("C", 1.33, 0, 0), ("H", -0.55, 0.93, 0), ("H", -0.55, -0.93, 0), ("H", 1.88, 0.93, 0), ("H", 1.88, -0.93, 0)]
    block = geometry(atoms).replace("  6  0  0", "  6  5  0", 1).replace("M  END", "\n".join(f"{a:3d}{b:3d}  1  0" for a, b in ((1, 2), (1, 3), (1, 4), (2, 5), (2, 6))) + "\nM  END")
    df = spark.createDataFrame([(1, block, 0)], "row_seq bigint, mol_block string, FormalCharge int")
    by = lambda **k: pipeline.curate(df, pipeline.Options(stages=("filter",), **k)).first()["filter_reason"]
    assert by() == "radicals=2" and by(geometry=True) is None
    from corundum.plans import cli

    assert cli._parser().parse_args(["curate", "a", "b", "--geometry"]).geometry and not cli._parser().parse_args(["curate", "a", "b"]).geometry


@pytest.mark.parametrize(
    ("text", "logp"),
    [("c1ccccc1", 1.6866), ("CCO", -0.0014), ("Cc1ccccc1", 1.9950), ("Oc1ccccc1", 1.3922), ("CC(=O)O", 0.0909), ("c1ccncc1", 1.0816), ("CC(=O)Oc1ccccc1C(=O)O", 1.3101),
     ("Cn1cnc2c1c(=O)n(C)c(=O)n2C", -1.0293), ("CC(=O)Nc1ccc(O)cc1", 1.3506), ("CC(C)Cc1ccc(cc1)C(C)C(=O)O", 3.0732), ("CC#N", 0.5299), ("CS(C)=O", -0.0053), ("[O-][N+](=O)c1ccccc1", 1.5948)],
)
def test_logp_of_known_molecules(text, logp):
    assert chem.partition(chem.parse_smiles(text)) == pytest.approx(logp, abs=1e-4)
    explicit = chem.parse_smiles(chem.write_smiles(chem.parse_smiles(text)))
    assert chem.partition(explicit) == pytest.approx(logp, abs=1e-4)


def block(atoms, bonds, wedges=None):
    lines = [f"{x:10.4f}{y:10.4f}{z:10.4f} {s:<3s} 0  0" for s, x, y, z in atoms]
    lines += [f"{a:3d}{b:3d}{k:3d}{(wedges or {}).get((a, b), 0):3d}" for a, b, k in bonds]
    return "\n".join(["t", "", "", f"{len(atoms):3d}{len(bonds):3d}  0  0  0  0  0  0  0  0999 V2000", *lines, "M  END"])


STAR = [(1, 2, 1), (1, 3, 1), (1, 4, 1), (1, 5, 1)]


def halide(sign=1, flip=()):
    """CHFClBr; its mirror image with sign -1."""
    return block([("C", 0, 0, 0), ("F", 0, 0, 1), ("Cl", 0.9, 0, -0.3), ("Br", -0.5, 0.8 * sign, -0.3), ("H", -0.5, -0.8 * sign, -0.3)], STAR)


def test_handedness_comes_from_coordinates():
    right, left = chem.block_texts(halide()), chem.block_texts(halide(-1))
    assert right[0] != left[0] and right[1] == left[0] and left[1] == right[0] and right[2] and left[2]
    # Seen from the fluorine, chlorine, bromine and hydrogen turn to the left.
    assert chem.write_smiles(chem.without_hydrogens(chem.parse_smiles("F[C@](Cl)(Br)[H]"))) == right[0]
    # Any order of the atoms gives the same text, and turning the molecule does too.
    turned = block([("Br", 0.8, 0.5, -0.3), ("H", -0.8, 0.5, -0.3), ("C", 0, 0, 0), ("Cl", 0, -0.9, -0.3), ("F", 0, 0, 1)], [(3, 5, 1), (3, 4, 1), (3, 1, 1), (3, 2, 1)])
    assert chem.block_texts(turned)[0] in (right[0], left[0])
    # Two equal neighbours, or all in one plane: no centre.
    assert not chem.block_texts(halide().replace("Br ", "Cl "))[2]
    flat = block([("C", 0, 0, 0), ("F", 0, 1, 0), ("Cl", 1, 0, 0), ("Br", 0, -1, 0), ("H", -1, 0, 0)], STAR)
    assert not chem.block_texts(flat)[2]
    # In a flat drawing the wedge decides.
    drawn = [("C", 0, 0, 0), ("F", 0, 1, 0), ("Cl", 0.9, -0.5, 0), ("Br", -0.9, -0.5, 0), ("H", 0.3, -1, 0)]
    up, down = (chem.block_texts(block(drawn, STAR, {(1, 2): w})) for w in (1, 6))
    assert up[2] and down[2] and up[0] == down[1] != down[0]


def test_mirror_pair_through_the_pipeline(spark):
    rows = [(1, halide(), -1.0), (2, halide(-1), -1.0), (3, halide(), -1.0), (4, GOOD, -1.0), (5, "x", -1.0)]
    df = spark.createDataFrame(rows, "row_seq bigint, mol_block string, Energy_Ha double")
    got = {r["row_seq"]: r for r in pipeline.curate(df, pipeline.Options(preset="none")).collect()}
    assert [got[i]["stereo_status"] for i in (1, 2, 3, 4, 5)] == ["kept", "removed_enantiomer", "kept", "kept", "skipped_no_smiles"]
    assert got[1]["CompoundID"] == got[3]["CompoundID"] != got[2]["CompoundID"] and got[3]["dedup_status"] == "conformer_duplicate" and got[2]["dedup_status"] == "ok"
    assert got[1]["validate_errors"] is not None and got[5]["mol_block"] == "x"


def test_template_gives_bonds_that_cannot_be_written(spark):
    ring = lambda n: block([("C", i, 0.3 * i * i, 0) for i in range(n)], [(i + 1, (i + 1) % n + 1, 4) for i in range(n)])
    six, five = ring(6), ring(5)
    assert chem.block_texts(six)[0] is not None and chem.block_texts(six)[9] is None
    rows = [(1, five, None), (2, five, "C1=CCC=C1"), (3, five, "CCCC"), (4, five, "C("), (5, six, None)]
    df = spark.createDataFrame(rows, "row_seq bigint, mol_block string, SMILES string")
    got = {r["row_seq"]: (r["dedup_status"], r["dedup_reason"]) for r in dedup.canonicalize(df).collect()}
    assert got == {1: ("bond_assignment_failed", "kekulize failed, no SMILES for template"), 2: (None, None), 3: ("bond_assignment_failed", "template fallback failed"), 4: ("bond_assignment_failed", "SMILES tag unparseable"), 5: (None, None)}
    written = chem.reorder_block(five, "C1=CCC=C1")
    assert sorted(x[6:9] for x in written.split("\n")[9:14]) == ["  1"] * 3 + ["  2"] * 2


def test_other_orders_of_atoms(spark, tmp_path):
    ranked, by_rank = chem.reorder_block(halide()), chem.reorder_block(halide(), by_rank=True)
    assert sorted(ranked.split("\n")[4:9]) == sorted(by_rank.split("\n")[4:9]) and chem.block_texts(by_rank)[0] == chem.block_texts(ranked)[0]
    script = tmp_path / "reverse.sh"
    script.write_text('{ head -2 "$1"; tail -n +3 "$1" | tac; } > "$1.new" && mv "$1.new" "$1"\n')
    df = spark.createDataFrame([(1, halide(), -1.0), (2, "x", -1.0)], "row_seq bigint, mol_block string, Energy_Ha double")
    run = lambda command: {r["row_seq"]: r for r in pipeline.curate(df, pipeline.Options(stages=("reorder",), order_command=command)).collect()}
    got = run(("sh", str(script)))
    assert [x[31:34].strip() for x in got[1]["mol_block"].split("\n")[4:9]] == ["H", "Br", "Cl", "F", "C"] and got[1]["reorder_status"] == "ok" and got[2]["reorder_status"] == "failed"
    assert chem.block_texts(got[1]["mol_block"])[0] == chem.block_texts(halide())[0]
    absent = run(("no-such-program",))
    assert absent[1]["reorder_status"] == "failed" and absent[1]["mol_block"] == halide()


def test_salts_follow_the_rows(spark):
    from corundum.session import salted_join

    rows = [(i, "hot" if i % 2 else None if i % 3 else f"k{i % 40}") for i in range(6000)]
    big = spark.createDataFrame(rows, "i int, k string")
    small = big.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("least"))
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for k, v in zip(("adaptive.enabled", "autoBroadcastJoinThreshold", "shuffle.partitions"), ("false", "-1", "16"), strict=True):
            spark.conf.set(f"spark.sql.{k}", v)
        for weight in (None, "n"):
            for how in ("left", "inner"):
                met = salted_join(big, small, ["k"], how, weight=weight, by=["i"], task_rows=150)
                plain = big.join(small, "k", how)
                assert sorted(map(str, met.select("i", "k", "least").collect())) == sorted(map(str, plain.select("i", "k", "least").collect()))
        largest = salted_join(big, small, ["k"], "left", weight="n", task_rows=150).groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        for k, v in zip(("adaptive.enabled", "autoBroadcastJoinThreshold", "shuffle.partitions"), before, strict=True):
            spark.conf.set(f"spark.sql.{k}", v)
    assert largest < 1500  # of 6,000 rows, half of one key and a third null


def test_prefilter_over_smiles_equals_least_squares(spark):
    rng = np.random.default_rng(3)
    texts = ["C" * int(n) + "O" * int(o) + ("N" if i % 3 else "S") for i, (n, o) in enumerate(rng.integers(1, 6, (60, 2)))]
    counts = np.array([[chem.smiles_composition(t).get(e, 0) for e in energy.SMILES_ELEMENTS] for t in texts], float)
    y = counts @ np.array([-37.8, -0.5, -54.6, -75.1, -398.1, 0, 0, 0, 0, 0]) + rng.normal(0, 0.01, 60)
    y[7] += 30
    rows = [(f"z{i}", t, float(e)) for i, (t, e) in enumerate(zip(texts, y, strict=True))] + [("bad", "C(", None), ("nan", "C", float("nan"))]
    main = spark.createDataFrame(rows, "Zinc_id string, smile string, `Internal_E(0K)` double")
    got = {r["Zinc_id"]: r for r in energy.smiles_prefilter(main).collect()}
    used = counts.sum(0) > 0
    res = y - counts[:, used] @ np.linalg.lstsq(counts[:, used], y, rcond=None)[0]
    z = 0.6745 * (res - np.median(res)) / np.median(np.abs(res - np.median(res)))
    assert np.allclose([got[f"z{i}"]["z_residual"] for i in range(60)], z, rtol=1e-4, atol=1e-3)
    assert got["z7"]["energy_status"] == "flagged" and got["bad"]["energy_status"] == got["nan"]["energy_status"] == "energy_nonfinite"
    assert (got["z0"]["NAT"], got["z0"]["S_count"]) == (int(counts[0].sum()), 1) and got["bad"]["NAT"] == 0 and got["bad"]["E_per_atom"] is None
    flagged = energy.flagged_rows(energy.smiles_prefilter(main))
    assert flagged.columns == ["Zinc_id", "energy_status", "S_count", "E_per_atom", "z_residual", "smile", "NAT", "Internal_E(0K)"] and flagged.filter("Zinc_id = 'z7'").count() == 1
    assert {r["energy_status"] for r in energy.smiles_prefilter(main.select("Zinc_id", "smile")).collect()} == {"ok"} and energy.smiles_prefilter(main.limit(0)).count() == 0


def test_statistics_table_against_brute_force(spark):
    forms = ["CCO", "CCN", "CCO", "c1ccccc1", "C(", None, "", "CC(=O)O"]
    df = spark.createDataFrame([(i, f"c{i % 3}", f"s{i}", s, -1.0 * i) for i, s in enumerate(forms)], "row_seq bigint, CompoundID string, SourceID string, CanonicalSMILES string, Energy_Ha double")
    bits = {s: {64 * k + b for k, w in enumerate(chem.fingerprint(chem.parse_smiles(s))) for b in range(64) if w >> b & 1} for s in forms if s and s != "C("}
    rows = [(i, s) for i, s in enumerate(forms) if s]
    want = {i: max((len(bits[s] & bits[t]) / len(bits[s] | bits[t]) for j, t in rows if j != i and t in bits), default=None) if s in bits else None for i, s in rows}
    got = {r["row_seq"]: r for r in stats.stats_table(df, tanimoto=True).collect()}
    assert {i: r["max_tanimoto"] for i, r in got.items()} == pytest.approx(want) and got[0]["max_tanimoto"] == 1.0 and got[4]["MolWt"] is None
    assert set(stats.STATS_COLUMNS) < set(stats.stats_table(df).columns) and stats.stats_table(df.limit(0), tanimoto=True).count() == 0
    asked = {r["row_seq"] for r in stats.stats_table(df, tanimoto=True, divisor=3).collect() if r["max_tanimoto"] is not None}
    assert asked == {0, 3}
    table = stats.stats_table(df, tanimoto=True)
    report = {r["name"]: r for r in stats.descriptor_report(table).collect()}
    assert report["TPSA"]["share_below_limit"] == 1.0 and report["MolWt"]["n"] == 5
    firsts = [got[i]["max_tanimoto"] for i in (0, 1, 2)]
    one = stats.tanimoto_report(table).first()
    assert one["n"] == 3 and one["mean"] == pytest.approx(np.mean(firsts)) and one["twins"] == sum(v == 1 for v in firsts)
    assert stats.tanimoto_report(table.limit(1)).count() == 0


def test_charges_are_added_exactly(spark):
    tenths = [0.1] * 5
    df = spark.createDataFrame([(1, tenths), (2, [0.1, 0.2, 0.3, 0.9]), (3, [float("inf")])], "i int, q array<double>")
    assert [r[0] for r in df.orderBy("i").select(assemble.formal_charge(df["q"])).collect()] == [0, 2, None]


def test_molecules_of_other_ids_meet_and_large_ones_are_reported(spark):
    from corundum.operators import deliver

    main = spark.createDataFrame([("chem-bl 12", "C", -1.0), ("Z" * 3, "C", -1.0)], "Zinc_id string, smile string, `Internal_E(0K)` double")
    xyz = spark.createDataFrame([(i, "CHEMBL12", "C", 0.0, 0.0, float(i), 0.0) for i in range(1000)] + [(2000, "zzz", "C", None, 0.0, 0.0, 0.0)], "xyz_seq int, Zinc_id string, atom string, final_x double, final_y double, final_z double, charge double")
    bond = spark.createDataFrame([], "bond_seq int, Zinc_id string, atom1 int, atom2 int")
    done = assemble.assemble(main, xyz, bond)
    why = {r["SourceID"]: r["why"] for r in done.select("SourceID", deliver.block_refusal(F.col("symbols"), F.col("coordinates"), F.col("bonds")).alias("why")).collect()}
    assert why == {"CHEMBL12": "beyond 999 atoms or bonds", "ZZZ": "a coordinate is missing"}


def test_assemble_left_join_adds_charges_as_its_sql_does(spark, tmp_path):
    import pyarrow.parquet as pq

    from tests.conftest import comparison

    # Sums of one half and one and a half; added as doubles in the order of atoms, six of them miss the tie.
    charges = [[0.1] * 5, [0.75, 0.75], [-0.4, -0.2, 0.1], [0.1, -0.2, -0.4], [0.2, 0.4, -0.1], [0.6, 0.7, 0.2], [0.2, 0.7, 0.6], [0.8, 0.8, 0.8, 0.1], [-0.4, -0.3, 0.4, 0.8], [-0.1, 0.7, 0.7, 0.2], [0.3, None], [0.3, float("nan")]]
    atoms = [(f"ZINC{i}", "C", 0.0, 0.0, 0.0, q) for i, qs in enumerate(charges, 1) for q in qs]
    tables = {
        "main": spark.createDataFrame([(f"ZINC{i}", "C", -1.0, "ok") for i in range(1, len(charges) + 1)], "Zinc_id string, smile string, `Internal_E(0K)` double, energy_status string"),
        "xyz": spark.createDataFrame([(n, *a) for n, a in enumerate(atoms)], "xyz_seq bigint, Zinc_id string, atom string, final_x double, final_y double, final_z double, charge double"),
        "bond": spark.createDataFrame([(1, "ZINC1", 1, 2)], "bond_seq bigint, Zinc_id string, atom1 int, atom2 int"),
    }
    for name, df in tables.items():
        pq.write_table(df.withColumn("loaded_at", F.lit("2024-01-01").cast("timestamp_ntz")).toArrow(), f"{tmp_path}/{name}.parquet")
    found = {r["SourceID"][-2:]: r["FormalCharge"] for r in curation.assemble_left_join(spark, str(tmp_path)).collect()}
    assert [found[f"{i:02}"] for i in range(1, len(charges) + 1)] == [0, 2, -1, 0, 1, 1, 2, 3, 1, 1, None, None]
    comparison(spark, str(tmp_path))(curation.assemble_left_join, curation.SQL["assemble_left_join"])


def test_broadcasts_are_measured_in_rows_and_bytes(spark):
    from corundum.session import fits, spread

    df = spark.range(100).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array(F.lit(1)).alias("a"))
    assert fits(df) and not fits(df, rows=99) and not fits(df, size=50_000) and fits(df.limit(0), rows=0)
    wide = spread(df.coalesce(1))
    assert wide.count() == 100 and wide.rdd.getNumPartitions() >= 8
    # What comes out of a shuffle is left alone.
    grouped = df.groupBy("id").count()
    assert spread(grouped) is grouped
