"""MDL V2000 blocks: projections as Spark expressions, the full validity test as an Arrow function."""

from __future__ import annotations

from math import isfinite

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

# The symbols of the chemical elements, by atomic number.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh "
    "Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr "
    "Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
).split()

NUMBER = r"[ \t]*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[ \t]*"


def finite_number(text: Column) -> Column:
    """The double that an ASCII decimal text shows, else null; blanks around it are fine, overflow to infinity is not."""
    value = F.trim(F.translate(text, "\t", " ")).try_cast("double")
    return F.when(text.rlike(rf"\A{NUMBER}\z") & ~value.isin(float("inf"), float("-inf")), value)


def whole_number(text: Column) -> Column:
    """The int that an ASCII digit text (sign allowed) shows, else null, also beyond the range of int."""
    return F.when(text.rlike(r"\A[ \t]*[+-]?[0-9]+[ \t]*\z"), F.trim(F.translate(text, "\t", " ")).try_cast("int"))


def block_lines(block: Column) -> Column:
    """Lines of a block; either kind of line end, final line ends dropped."""
    return F.split(F.regexp_replace(block, r"[\r\n]+\z", ""), r"\r?\n")


def _cut(line: Column, start: int, width: int) -> Column:
    return F.substring(line, start, width)


def _count(line: Column, start: int) -> Column:
    return F.trim(_cut(line, start, 3)).try_cast("int")


def head_line(block: Column) -> Column:
    """The counts line of a block; null for a null block or one of fewer lines."""
    return F.get(F.split(F.substring_index(block, "\n", 4), r"\r?\n"), F.lit(3))


def head_counts(head: Column) -> tuple[Column, Column]:
    """(atoms, bonds) of a counts line, null where the columns hold no unsigned number."""
    ok = lambda s: F.when(_cut(head, s, 3).rlike(r"\A *[0-9]+ *\z"), _count(head, s))
    return ok(1), ok(4)


def counts(lines: Column) -> tuple[Column, Column]:
    """(atoms, bonds) of the counts line among a block's lines."""
    return head_counts(F.get(lines, F.lit(3)))


_COORDINATE = frozenset("0123456789+-. eE")
_COUNT = frozenset("0123456789 ")
_ELEMENTS = frozenset(ELEMENTS)


def is_block(block: str | None) -> bool:
    """Whether a text is a whole V2000 block; false for null.

    Three header lines; a counts line ending in V2000; the atom lines (three finite numbers, an element in columns
    32-34); the bond lines (two different existing atoms, type 1 to 4); then only M lines, the last one M  END.
    """
    if block is None:
        return False
    lines = block.rstrip("\r\n").replace("\r\n", "\n").split("\n")
    if len(lines) < 5 or lines[-1] != "M  END" or not lines[3].endswith("V2000"):
        return False
    try:
        head = lines[3][:6]
        if not _COUNT.issuperset(head):
            return False
        n, m = int(head[:3]), int(head[3:])
        atoms, bonds, rest = lines[4 : 4 + n], lines[4 + n : 4 + n + m], lines[4 + n + m :]
        if len(bonds) < m or not rest or not _ELEMENTS.issuperset([x[31:34].strip(" ") for x in atoms]):
            return False
        texts = [t for x in atoms for t in (x[:10], x[10:20], x[20:30])]
        joined = "".join(texts)
        # Of these characters alone float() reads ASCII decimals and nothing else; only an exponent can overflow.
        if not _COORDINATE.issuperset(joined):
            return False
        numbers = [float(t) for t in texts]
        if ("e" in joined or "E" in joined) and not all(map(isfinite, numbers)):
            return False
        for x in bonds:
            cut = x[:9]
            a, b = int(cut[:3]), int(cut[3:6])
            if not _COUNT.issuperset(cut) or a == b or not 0 < a <= n or not 0 < b <= n or not 1 <= int(cut[6:]) <= 4:
                return False
    except ValueError:
        return False
    return all(x.startswith("M  ") for x in rest)


@F.arrow_udf(BooleanType())
def block_valid(block: pa.Array) -> pa.Array:
    """is_block over Arrow batches: lambdas over the lines inside the JVM took many times as long."""
    return pa.array([is_block(b.as_py()) for b in block], pa.bool_())


def atom_symbols(block: Column) -> Column:
    """Element symbols of the atom lines, in order."""
    lines = block_lines(block)
    n = F.coalesce(counts(lines)[0], F.lit(0))
    return F.transform(F.slice(lines, F.lit(5), n), lambda x: F.trim(_cut(x, 32, 3)))


def atoms(block: Column) -> Column:
    """array<struct<symbol, x, y, z>> of the atom lines."""
    lines = block_lines(block)
    n = F.coalesce(counts(lines)[0], F.lit(0))
    num = lambda x, s: F.trim(_cut(x, s, 10)).try_cast("double")
    return F.transform(F.slice(lines, F.lit(5), n), lambda x: F.struct(F.trim(_cut(x, 32, 3)).alias("symbol"), num(x, 1).alias("x"), num(x, 11).alias("y"), num(x, 21).alias("z")))


def bonds(block: Column) -> Column:
    """array<struct<a, b, kind>> of the bond lines; atoms count from 1."""
    lines = block_lines(block)
    n, m = (F.coalesce(c, F.lit(0)) for c in counts(lines))
    return F.transform(F.slice(lines, n + 5, m), lambda x: F.struct(_count(x, 1).alias("a"), _count(x, 4).alias("b"), _count(x, 7).alias("kind")))


def formula(symbols: Column) -> Column:
    """Composition by element in alphabetical order, a count of one left out; null in, null out."""
    kinds = F.array_sort(F.array_distinct(symbols))
    part = lambda e: F.concat(e, (lambda k: F.when(k > 1, k.cast("string")).otherwise(""))(F.size(F.filter(symbols, lambda s: s == e))))
    return F.when(symbols.isNotNull(), F.concat_ws("", F.transform(kinds, part)))


def cut_block(block: Column) -> Column:
    """The block up to and with its first M  END; unchanged where there is none."""
    return F.when(block.contains("M  END"), F.concat(F.substring_index(block, "M  END", 1), F.lit("M  END"))).otherwise(block)
