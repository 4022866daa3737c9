"""Energy outliers: a global least-squares fit on composition, and a robust z-score of its residuals."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from corundum.functions import chem
from corundum.functions.arrow import by_row
from corundum.operators.medians import exact_median
from corundum.schema import FIT_ELEMENTS
from corundum.session import materialise, spread

THRESHOLD = 3.5
CONSISTENCY = 0.6745
# Element types of the fit over SMILES.
SMILES_ELEMENTS = ("C", "H", "N", "O", "S", "F", "Cl", "Br", "P", "I")


def element_counts(symbols: Column, elements: tuple[str, ...] = FIT_ELEMENTS) -> dict[str, Column]:
    """n_<element> by element; other elements are not counted, a null list counts nothing."""

    def count(element: str) -> Column:
        return F.when(symbols.isNotNull(), F.size(F.filter(symbols, lambda s: s == element))).otherwise(0)

    return {f"n_{e}": count(e) for e in elements}


def _finite(c: Column) -> Column:
    return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))


def fit_composition(df: DataFrame, counts: list[str], energy: str) -> dict[str, float]:
    """Energy of each element: least squares without intercept over the rows with finite energy.

    Only the k x k normal matrix leaves the executors; its pseudo-inverse gives the least-norm answer where elements are
    collinear. Elements that no row has get no coefficient.
    """
    rows = df.filter(_finite(F.col(energy)))
    k = len(counts)
    cells = [F.sum(F.col(counts[i]).cast("double") * F.col(counts[j])) for i in range(k) for j in range(i, k)]
    sums = rows.agg(*cells, *[F.sum(F.col(c) * F.col(energy)) for c in counts]).first()
    gram, at = np.zeros((k, k)), 0
    for i in range(k):
        for j in range(i, k):
            gram[i, j] = gram[j, i] = sums[at] or 0.0
            at += 1
    target = np.array([s or 0.0 for s in sums[at:]])
    used = [i for i in range(k) if gram[i, i] > 0]
    if not used:
        return {}
    # Scaled to a unit diagonal, so that rare elements don't fall below the rank tolerance.
    scale = 1 / np.sqrt(gram.diagonal()[used])
    inner = np.linalg.pinv(gram[np.ix_(used, used)] * np.outer(scale, scale), rcond=1e-12, hermitian=True)
    beta = scale * (inner @ (scale * target[used]))
    return {counts[i]: float(b) for i, b in zip(used, beta, strict=True)}


def flag_outliers(df: DataFrame, counts: list[str], energy: str, threshold: float = THRESHOLD, written: bool = False) -> tuple[DataFrame, dict[str, float]]:
    """(df with residual, z_residual and energy_status, coefficients).

    energy_status: `flagged` if |z| > threshold, `energy_nonfinite` for null, NaN and infinite energies, which take no
    part in the fit, else `ok`. With a median deviation of 0 nothing is flagged and z is null. The fit and the medians
    read a narrow copy of counts and energies, written once, or df itself if it is `written` already.
    """
    narrow = df if written else materialise(df.select(*counts, energy))
    beta = fit_composition(narrow, counts, energy)
    fitted = sum((F.col(c) * b for c, b in beta.items()), F.lit(0.0))
    residual = F.when(_finite(F.col(energy)), F.col(energy) - fitted)
    middle = exact_median(narrow, residual)
    spread = None if middle is None else exact_median(narrow, F.abs(residual - middle))
    z = F.lit(None).cast("double") if not spread else CONSISTENCY * (F.col("residual") - middle) / spread
    status = F.when(F.col("residual").isNull(), "energy_nonfinite").when(F.abs("z_residual") > threshold, "flagged").otherwise("ok")
    return df.withColumn("residual", residual).withColumn("z_residual", z).withColumn("energy_status", status), beta


def block_counts(block: Column, elements: tuple[str, ...]) -> Column:
    """array<int>: atoms of each element in the atom lines; null for a block without any. An Arrow function, so that the
    ten counts come from one reading of the block however often they are used."""

    def count(text: str | None) -> list[int] | None:
        lines = (text or "").split("\n")
        if len(lines) < 5 or not lines[3][:3].strip().isdigit():
            return None
        symbols = [x[31:34].strip() for x in lines[4 : 4 + int(lines[3][:3])]]
        return [symbols.count(e) for e in elements] if symbols else None

    return by_row(count, ArrayType(IntegerType()))(block)


def energy_prefilter(batch: DataFrame, threshold: float = THRESHOLD, elements: tuple[str, ...] = FIT_ELEMENTS, counts: Column | None = None, written: bool = False) -> DataFrame:
    """The stage over batch records: composition from the atom lines; records without a readable one are `mol_corrupt`.

    `counts`: the atoms of each of the elements, if they are at hand.
    """
    names = [f"n_{e}" for e in elements]
    counted = batch.withColumn("__counts", block_counts(F.col("mol_block"), elements) if counts is None else counts).withColumns({n: F.get("__counts", F.lit(i)) for i, n in enumerate(names)})
    # A corrupt record has null counts and so neither takes part in the fit nor gets a residual.
    energy = F.when(F.col("__counts").isNotNull(), F.col("Energy_Ha"))
    done, _ = flag_outliers(counted.withColumn("__energy", energy), names, "__energy", threshold, written)
    status = F.when(F.col("__counts").isNull(), "mol_corrupt").otherwise(F.col("energy_status"))
    return done.withColumn("energy_status", status).drop("__counts", "__energy", *names)


def smiles_counts(smiles: Column, elements: tuple[str, ...] = SMILES_ELEMENTS) -> Column:
    """array<int>: atoms of each element in a SMILES text, hydrogens among them; all 0 for null and unreadable ones."""

    def count(text: str | None) -> list[int]:
        found = chem.smiles_composition(text)
        return [found.get(e, 0) for e in elements]

    return by_row(count, ArrayType(IntegerType()))(smiles)


def smiles_prefilter(main: DataFrame, energy: str = "Internal_E(0K)", smiles: str = "smile", threshold: float = THRESHOLD) -> DataFrame:
    """main with NAT, S_count, E_per_atom, z_residual and energy_status, from the composition of the SMILES.

    NAT counts the atoms of the fit's elements. E_per_atom is null where there are none. Without an energy column every
    row is `ok` and the numbers are null; rows without a finite energy are `energy_nonfinite`.
    """
    kept = [c for c in main.columns if c not in ("NAT", "S_count", "E_per_atom", "z_residual", "energy_status")]
    if energy not in main.columns:
        numbers = {"NAT": "int", "S_count": "int", "E_per_atom": "double", "z_residual": "double"}
        return main.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(None).cast(t).alias(c) for c, t in numbers.items()], F.lit("ok").alias("energy_status"))
    names = [f"n_{e}" for e in SMILES_ELEMENTS]
    # Written once: the fit and its medians read counts and energies several times.
    counted = materialise(spread(main.select(*[F.col(f"`{c}`") for c in kept])).withColumns({"__c": smiles_counts(F.col(f"`{smiles}`")), "__e": F.col(f"`{energy}`").cast("double")}))
    counted = counted.withColumns({n: F.get("__c", F.lit(i)) for i, n in enumerate(names)})
    done, _ = flag_outliers(counted, names, "__e", threshold, written=True)
    nat = sum((F.col(n) for n in names), F.lit(0)).cast("int")
    return done.select(*[F.col(f"`{c}`") for c in kept], nat.alias("NAT"), F.col("n_S").alias("S_count"), F.try_divide(F.col("__e"), nat).alias("E_per_atom"), "z_residual", "energy_status")


def flagged_rows(done: DataFrame, energy: str = "Internal_E(0K)", smiles: str = "smile") -> DataFrame:
    """The flagged rows of smiles_prefilter with the columns of the flagged table, in its order."""
    wanted = ("Zinc_id", "energy_status", "S_count", "E_per_atom", "z_residual", smiles, "NAT", energy)
    return done.filter("energy_status = 'flagged'").select(*[F.col(f"`{c}`") for c in wanted if c in done.columns])


def feature_presence(df: DataFrame, counts: list[str]) -> DataFrame:
    """element, molecules: how many rows have each element."""
    sums = df.agg(*[F.count_if(F.col(c) > 0).alias(c) for c in counts])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(c[2:]).alias("element"), F.col(c).alias("molecules")) for c in counts])).alias("x")).select("x.*")
