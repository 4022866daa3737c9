import math

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

from corundum.operators.deliver import build_block, frames
from corundum.schema import MAIN
from corundum.sinks import writers
from corundum.sources import batches, sdf
from corundum.streaming import stages
from pyspark.sql import functions as F
from tests.test_parse_errors import GOOD


def record(block, **tags):
    return block + "\n" + "".join(f"> <{k}>\n{v}\n\n" for k, v in tags.items()) + "$$$$\n"


def test_structure_files(spark, tmp_path):
    text = record(GOOD, Energy_Ha="-1.5", FormalCharge="0", Multiplicity="1", SMILES="CCl", Note="two\nlines") + record("broken", Energy_Ha="1") + record(GOOD, Energy_Ha="x")
    (tmp_path / "a.sdf").write_text(text)
    (tmp_path / "b.sdf").write_bytes(text.replace("\n", "\r\n").encode())
    for name in "ab":
        got = sdf.read_sdf(spark, str(tmp_path / f"{name}.sdf")).orderBy("row_seq").collect()
        assert [r["parsed"] for r in got] == [True, False, True]
        assert got[0]["tags"] == {"Energy_Ha": "-1.5", "FormalCharge": "0", "Multiplicity": "1", "SMILES": "CCl", "Note": "two\nlines"}
        rows = sdf.to_rows(sdf.read_sdf(spark, str(tmp_path / f"{name}.sdf"))).orderBy("row_seq").collect()
        assert [(r["Energy_Ha"], r["num_atoms"], r["num_bonds"]) for r in rows] == [(-1.5, 2, 1), (None, 2, 1)]
    assert sdf.count_records(spark, str(tmp_path / "a.sdf")) == 3 and sdf.count_records(spark, str(tmp_path / "none.sdf")) == 0
    again = sdf.to_rows(sdf.read_sdf(spark, str(tmp_path / "a.sdf")))
    writers.write_sdf(again, str(tmp_path / "out"))
    back = sdf.to_rows(sdf.read_sdf(spark, str(tmp_path / "out")))
    key = ["Energy_Ha", "SMILES", "mol_block", "num_atoms"]
    assert sorted(map(str, back.select(key).collect())) == sorted(map(str, again.select(key).collect()))


def test_batches_of_different_types_read_together(spark, tmp_path):
    d = tmp_path / "batches"
    d.mkdir()
    pq.write_table(pa.table({"SMILES": ["C", "CC"], "ICONF": pa.array([1, None], pa.int32()), "Energy_Ha": [1.0, 2.0]}), d / "batch_0000.parquet")
    pq.write_table(pa.table({"SMILES": ["CCC", "CCCC"], "ICONF": [1.0, math.nan], "Energy_Ha": [3.0, 4.0]}), d / "batch_0001.parquet")
    got = batches.read_batches(spark, str(d)).orderBy("row_seq").collect()
    assert [(r["SMILES"], r["ICONF"]) for r in got] == [("C", 1), ("CC", None), ("CCC", 1), ("CCCC", None)]
    assert got[0]["mol_block"] is None
    out = spark.createDataFrame([(i, f"s{i}") for i in range(25)], "row_seq bigint, SMILES string")
    writers.write_batches(out, str(tmp_path / "written"), rows_per_file=10)
    assert batches.read_batches(spark, str(tmp_path / "written")).orderBy("row_seq").select("SMILES").collect() == out.select("SMILES").collect()


def test_delimited(spark, tmp_path):
    pd.DataFrame({"Zinc_id": ["a"], "smile": ["C"], "Internal_E(0K)": [1.5], "HOMO": [None], "LUMO": [0.1], "HL_gap": [0.2], "energy_status": ["ok"]}).to_csv(tmp_path / "main.csv", index=False)
    row = batches.read_csv(spark, str(tmp_path / "main.csv"), MAIN).first()
    assert row["Internal_E(0K)"] == 1.5 and row["HOMO"] is None
    writers.write_csv(spark.createDataFrame([(1, None, math.nan)], "a int, b string, c double").coalesce(1), str(tmp_path / "csv"))
    text = next((tmp_path / "csv").glob("part-*.csv")).read_text()
    assert text.splitlines() == ["a,b,c", "1,,nan"] or text.lower().splitlines() == ["a,b,c", "1,,nan"]


def test_frames_and_rejects(spark, tmp_path):
    rows = [(1, GOOD, "S", "c", 0, 1, -12345678.9, "CCl", None), (2, None, None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, "row_seq bigint, mol_block string, SourceID string, CompoundID string, FormalCharge int, Multiplicity int, Energy_Ha double, CanonicalSMILES string, ICONF int")
    (frame,) = frames(df).collect()
    lines = frame["frame"].split("\n")
    assert lines[0] == "2"
    assert lines[1] == "SourceID,S,CompoundID,c,Formula,CCl,Nat,2,CNSO,1,chrg,0,mult,1,E,-12345678.9,fmax,,Family,QM40,smiles,CCl,tpsa,0.00,logp,0.85,nrot,0,nfrag,1,iconf,1"
    assert lines[2] == "C   0.000000  1.000000  -1.500000" and lines[3].startswith("Cl  1.000000")
    out = writers.reject_records(df.withColumn("why", F.lit("charge=+1")), "why").collect()
    assert len(out) == 1 and out[0]["value"].endswith("> <reject_reason>\ncharge=+1\n\n$$$$\n")
    writers.write_frames(df, str(tmp_path / "frames"))
    assert frame["frame"] in "".join(p.read_text() for p in (tmp_path / "frames").glob("part-*"))


def test_built_block_reads_back(spark):
    from corundum.functions.v2000 import is_block

    df = spark.createDataFrame([("t", ["C", "Cl"], [0.0, 1.0, 2.0, 3.0, 4.0, 5.0], [(1, 2)]), ("u", ["C"], [0.0, None, 1.0], []), ("v", [], [], None)], "t string, s array<string>, x array<double>, b array<struct<a:int,b:int>>")
    blocks = [r[0] for r in df.select(build_block(F.col("t"), F.col("s"), F.col("x"), F.col("b"))).collect()]
    assert is_block(blocks[0]) and blocks[1] is None and is_block(blocks[2])


def test_streams(spark, tmp_path):
    d = tmp_path / "in"
    schema = "row_seq bigint, key string, at timestamp"
    spark.sql("select * from values (1L, 'a', timestamp'2024-01-01'), (2L, 'a', timestamp'2024-01-01 01:00:00'), (3L, null, timestamp'2024-01-01'), (4L, 'b', timestamp'2024-01-02') t(row_seq, key, at)").coalesce(1).write.parquet(str(d))
    from pyspark.sql.types import _parse_datatype_string

    stream = stages.stream_batches(spark, str(d), _parse_datatype_string(schema))
    q = stages.stream_first(stream, "key", "at").writeStream.format("memory").queryName("firsts").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["key"] for r in spark.sql("select key from firsts").collect()) == ["a", "b"]


def test_command_line(spark, tmp_path):
    from corundum.plans import cli

    good = {"FormalCharge": "0", "Multiplicity": "1", "SMILES": "CCl", "SourceID": "s"}
    (tmp_path / "in.sdf").write_text("".join(record(GOOD, Energy_Ha=str(-i), **good) for i in range(1, 6)) + record(GOOD, **good))
    path = lambda name: str(tmp_path / name)
    assert cli.main(["validate", path("in.sdf"), path("bad")], spark) == 1
    assert spark.read.parquet(path("bad")).first()["reason"] == "Energy_Ha: missing (required)"
    assert cli.main(["split", path("in.sdf"), path("batches"), "-b", "2"], spark) == 0
    assert cli.main(["curate", path("batches"), path("done"), "--preset", "none", "--rejects", path("why"), "--skip", "validate"], spark) == 0
    assert spark.read.parquet(path("done")).filter("dedup_status = 'ok'").count() == 1
    assert cli.main(["report", path("done"), "--funnel-only"], spark) == 0
    assert cli.main(["frames", path("done"), path("frames"), "--exclude", "dedup_status=conformer_duplicate"], spark) == 0


def test_structure_files_keep_their_order(spark, tmp_path):
    # Pieces of very different sizes, as Spark packs the largest first.
    for name, n in (("b", 3), ("a", 400), ("c", 60)):
        (tmp_path / f"{name}.sdf").write_text("".join(record(GOOD, SourceID=f"{name}{i:04d}") for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        got = [r["tags"]["SourceID"] for r in sdf.read_sdf(spark, str(tmp_path)).orderBy("row_seq").collect()]
        seqs = [r["row_seq"] for r in sdf.read_sdf(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == [f"{name}{i:04d}" for name, n in (("a", 400), ("b", 3), ("c", 60)) for i in range(n)] and len(set(seqs)) == 463


def test_commands_over_delimited_tables(spark, tmp_path, capsys):
    from corundum.plans import cli

    path = lambda name: str(tmp_path / name)
    smiles = ["C", "CC", "CCC", "CCO", "C[N+](C)(C)C", "C(", "O"]
    energies = [-40.5, -79.8, -119.1, -155.0, -214.0, -1.0, -76.4]
    pd.DataFrame({"Zinc_id": [f"ZINC{i}" for i in range(7)], "smile": smiles, "Internal_E(0K)": energies, "HOMO": 0.1, "LUMO": 0.2, "HL_gap": 0.1}).to_csv(path("main.csv"), index=False)
    assert cli.main(["filter-smiles", path("main.csv"), path("passed"), path("rejected")], spark) == 0
    read = lambda name: pd.concat([pd.read_csv(f) for f in (tmp_path / name).glob("part-*.csv")])
    assert sorted(read("passed")["smile"]) == ["C", "CC", "CCC", "CCO", "O"]
    assert sorted(read("rejected")["reason"]) == ["charge=+1", "smiles_unparseable"] and list(read("rejected").columns) == ["Zinc_id", "smile", "reason"]
    assert cli.main(["energy-prefilter", path("passed"), path("energies"), path("flagged")], spark) == 0
    assert set(read("energies")["energy_status"]) == {"ok"}
    pd.DataFrame({"Zinc_id": ["ZINC6"] * 3 + ["ZINC0"] * 2, "atom": ["O", "H", "H", "C", "H"], "final_x": range(5), "final_y": 0.0, "final_z": 0.0, "charge": [-0.5, 0.25, 0.25, 0.25, 0.25]}).to_csv(path("xyz.csv"), index=False)
    pd.DataFrame({"Zinc_id": ["ZINC6", "ZINC6"], "atom1": [1, 1], "atom2": [2, 3]}).to_csv(path("bond.csv"), index=False)
    assert cli.main(["convert", path("energies"), path("xyz.csv"), path("bond.csv"), path("sdf")], spark) == 0
    rows = {r["SourceID"]: r for r in sdf.to_rows(sdf.read_sdf(spark, path("sdf"))).collect()}
    assert (rows["ZINC000000000006"]["num_atoms"], rows["ZINC000000000006"]["num_bonds"], rows["ZINC000000000006"]["FormalCharge"]) == (3, 2, 0)
    assert rows["ZINC000000000000"]["FormalCharge"] == 0 and rows["ZINC000000000000"]["num_bonds"] == 0 and len(rows) == 2
    (tmp_path / "empty").mkdir()
    assert cli.main(["report", path("empty")], spark) == 1 and cli.main(["report", path("absent")], spark) == 1
    assert "no batches" in capsys.readouterr().err


def test_curate_command_warns_and_reports(spark, tmp_path, capsys):
    from corundum.plans import cli

    path = lambda name: str(tmp_path / name)
    rows = [(i, GOOD, "CCl", -500.0, 0, 1, f"s{i}", 2, 1) for i in range(3)]
    df = spark.createDataFrame(rows, "row_seq bigint, mol_block string, SMILES string, Energy_Ha double, FormalCharge int, Multiplicity int, SourceID string, num_atoms int, num_bonds int")
    df.write.parquet(path("in"))
    assert cli.main(["curate", path("in"), path("done"), "--rejects", path("why")], spark) == 0
    err = capsys.readouterr().err
    assert "3 rows that the stage filter turned down" in err
    assert cli.main(["stats", path("done"), path("stats"), "--tanimoto"], spark) == 0
    table = spark.read.parquet(path("stats")).collect()
    assert {r["max_tanimoto"] for r in table} == {1.0} and all(r["logP"] is not None for r in table)
    assert cli.main(["report", path("done"), "--rejects", path("why"), "--stats", path("stats")], spark) == 0
    assert "near_duplicates" in capsys.readouterr().out
    df.withColumn("Energy_Ha", F.lit(None).cast("double")).write.parquet(path("none"))
    assert cli.main(["curate", path("none"), path("done2"), "--preset", "none"], spark) == 1
