import random
from datetime import datetime, timedelta

from corundum.operators.orphans import key_runs, match_runs, orphan_references

MAIN = "Zinc_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz, key string"
CHILD = "Zinc_id string, loaded_at timestamp_ntz, present boolean"
T0 = datetime(2023, 1, 1)


def spelled(rng, n):
    return rng.choice([f"ZINC{n:012d}", f"zinc{n}", f" ZINC_{n:06d}\t", f"Zinc-{n}"])


def brute(main, children):
    number = lambda s: int("".join(c for c in s if c.isdigit())) if s and s.strip() else None
    out = set()
    for name, rows in children.items():
        for z, t, _ in rows:
            k = number(z)
            if k is None:
                continue
            own = [(a, d) for m, a, d, _ in main if number(m) == k]
            if any(a <= t and (d is None or d > t) for a, d in own):
                continue
            kind = "missing" if not own else "late" if all(a > t for a, _ in own) else "deleted"
            out.add((name, f"ZINC{k:012d}", f"{t:%Y-%m}", kind))
    have = {number(z) for z, _, _ in children["xyz"]}
    out |= {("main", f"ZINC{number(m):012d}", f"{a:%Y-%m}", "missing") for m, a, _, _ in main if number(m) is not None and number(m) not in have}
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    when = lambda: T0 + timedelta(hours=rng.randrange(24 * 90))
    keys = [*range(100, 130), *range(65_530, 65_545), 7]
    main = [(spelled(rng, k), (t := when()), rng.choice([None, t + timedelta(days=rng.randrange(40))]), "x") for k in rng.choices(keys, k=60)] + [(None, when(), None, None), ("  ", when(), None, None)]
    # Key 7 holds a third of all references.
    child = lambda n: [(spelled(rng, k), when(), True) for k in rng.choices([*keys, 99, 65_546, 300], k=n)] + [(spelled(rng, 7), when(), False) for _ in range(n // 2)] + [(None, when(), None), (" ", when(), None)]
    children = {"xyz": child(120), "bond": child(80)}
    # Ties: a reference at the very moment of loading, and of deletion.
    children["bond"] += [(main[0][0], main[0][1], None), (main[1][0], main[1][2] or main[1][1], None)]
    frames = {k: spark.createDataFrame(v, CHILD) for k, v in children.items()}
    got = orphan_references(spark.createDataFrame(main, MAIN), frames).collect()
    assert {tuple(r) for r in got} == brute(main, children)
    assert len(got) == len(set(got))


def test_empty_tables(spark):
    none = spark.createDataFrame([], MAIN)
    child = spark.createDataFrame([("ZINC1", T0, None)], CHILD)
    empty = child.limit(0)
    assert [tuple(r) for r in orphan_references(none, {"xyz": child, "bond": empty}).collect()] == [("xyz", "ZINC000000000001", "2023-01", "missing")]
    main = spark.createDataFrame([("zinc 1", T0, None, None)], MAIN)
    assert [tuple(r) for r in orphan_references(main, {"xyz": empty, "bond": empty}).collect()] == [("main", "ZINC000000000001", "2023-01", "missing")]


def test_odd_ids_and_missing_times(spark):
    main = spark.createDataFrame([("ABC-1", T0, None, None)], MAIN)
    child = spark.createDataFrame([("abc 1", T0, None), ("abd1", T0, None), ("abc1", None, None), ("zinc5", None, None)], CHILD)
    got = {tuple(r) for r in orphan_references(main, {"xyz": child}).collect()}
    assert got == {("xyz", "ABD1", "2023-01", "missing"), ("xyz", "ZINC000000000005", None, "missing")}


def test_runs(spark):
    keys = spark.createDataFrame([(k,) for k in [1, 2, 2, 3, 7, 65_535, 65_536, None]], "k bigint")
    runs = key_runs(keys, "k")
    assert sorted((r["run_start"], r["run_end"]) for r in runs.collect()) == [(1, 3), (7, 7), (65_535, 65_535), (65_536, 65_536)]
    asked = spark.createDataFrame([(k,) for k in [0, 1, 3, 4, 7, 8, 65_536, 65_537]], "k bigint")
    assert {r["k"] for r in match_runs(asked, "k", runs).filter("not present").collect()} == {0, 4, 8, 65_537}
