"""A small chemistry kernel in plain Python: SMILES and V2000 in, canonical text, composition and descriptors out.

It is self-consistent: texts of one molecule, however written, give one canonical text, as far as ring and stereo
symmetry is resolved by refinement. Its texts, and identifiers made from them, are its own; don't mix them with those
of another toolkit in one dataset (BACKEND names it).
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import dataclass, field, replace
from functools import lru_cache

from corundum.functions.v2000 import ELEMENTS, is_block

BACKEND = "corundum-2"

# Valences of the elements that SMILES writes without brackets.
VALENCES = {"B": (3,), "C": (4,), "N": (3, 5), "O": (2,), "P": (3, 5), "S": (2, 4, 6), "F": (1,), "Cl": (1,), "Br": (1,), "I": (1,)}
# Further elements' common valences, for radical counts; metals are left out.
VALENCES_IN_BRACKETS = VALENCES | {"H": (1,), "Si": (4,), "Se": (2, 4, 6), "As": (3, 5), "Al": (3,), "Ge": (4,), "Te": (2, 4, 6)}

# Standard atomic weights.
WEIGHTS = {
    "H": 1.008, "He": 4.003, "Li": 6.941, "Be": 9.012, "B": 10.812, "C": 12.011, "N": 14.007, "O": 15.999, "F": 18.998, "Ne": 20.18,
    "Na": 22.99, "Mg": 24.305, "Al": 26.982, "Si": 28.086, "P": 30.974, "S": 32.067, "Cl": 35.453, "Ar": 39.948, "K": 39.098, "Ca": 40.078,
    "Sc": 44.956, "Ti": 47.867, "V": 50.942, "Cr": 51.996, "Mn": 54.938, "Fe": 55.845, "Co": 58.933, "Ni": 58.693, "Cu": 63.546, "Zn": 65.39,
    "Ga": 69.723, "Ge": 72.61, "As": 74.922, "Se": 78.96, "Br": 79.904, "Kr": 83.8, "Rb": 85.468, "Sr": 87.62, "Y": 88.906, "Zr": 91.224,
    "Ag": 107.868, "Cd": 112.412, "In": 114.818, "Sn": 118.711, "Sb": 121.76, "Te": 127.6, "I": 126.904, "Xe": 131.29, "Cs": 132.905, "Ba": 137.328,
    "Pt": 195.078, "Au": 196.967, "Hg": 200.59, "Pb": 207.2, "Bi": 208.98,
}

# Published polar surface contributions of nitrogen and oxygen, by
# (element, hydrogens, charge, single, double, triple, aromatic bonds), and those in three-membered rings.
POLAR = {
    ("N", 0, 0, 3, 0, 0, 0): 3.24, ("N", 0, 0, 1, 1, 0, 0): 12.36, ("N", 0, 0, 0, 0, 1, 0): 23.79, ("N", 0, 0, 1, 2, 0, 0): 11.68,
    ("N", 0, 0, 0, 1, 1, 0): 13.60, ("N", 1, 0, 2, 0, 0, 0): 12.03, ("N", 1, 0, 0, 1, 0, 0): 23.85, ("N", 2, 0, 1, 0, 0, 0): 26.02,
    ("N", 0, 1, 4, 0, 0, 0): 0.00, ("N", 0, 1, 2, 1, 0, 0): 3.01, ("N", 0, 1, 1, 0, 1, 0): 4.36, ("N", 1, 1, 3, 0, 0, 0): 4.44,
    ("N", 1, 1, 1, 1, 0, 0): 13.97, ("N", 2, 1, 2, 0, 0, 0): 16.61, ("N", 2, 1, 0, 1, 0, 0): 25.59, ("N", 3, 1, 1, 0, 0, 0): 27.64,
    ("N", 0, 0, 0, 0, 0, 2): 12.89, ("N", 0, 0, 0, 0, 0, 3): 4.41, ("N", 0, 0, 1, 0, 0, 2): 4.93, ("N", 0, 0, 0, 1, 0, 2): 8.39,
    ("N", 1, 0, 0, 0, 0, 2): 15.79, ("N", 0, 1, 0, 0, 0, 3): 4.10, ("N", 0, 1, 1, 0, 0, 2): 3.88, ("N", 1, 1, 0, 0, 0, 2): 14.14,
    ("O", 0, 0, 2, 0, 0, 0): 9.23, ("O", 0, 0, 0, 1, 0, 0): 17.07, ("O", 1, 0, 1, 0, 0, 0): 20.23, ("O", 0, -1, 1, 0, 0, 0): 23.06,
    ("O", 0, 0, 0, 0, 0, 2): 13.14,
}
POLAR_IN_THREE_RING = {("N", 0): 3.01, ("N", 1): 21.94, ("O", 0): 12.53}

# V2000 atom-line charge codes.
CHARGE_CODES = {1: 3, 2: 2, 3: 1, 5: -1, 6: -2, 7: -3}

NUMBERS = {e: i + 1 for i, e in enumerate(ELEMENTS)}
_AROMATIC = {"b": "B", "c": "C", "n": "N", "o": "O", "p": "P", "s": "S", "se": "Se", "as": "As"}
_BRACKET = re.compile(r"\[(\d+)?(se|as|[bcnops]|[A-Z][a-z]?)(@{0,2})(?:H(\d*))?((?:\+\d+|-\d+|\++|-+)?)(?::\d+)?\]")
_PLAIN = re.compile(r"Cl|Br|[BCNOPSFI]|[bcnops]")
_ORDERS = {"-": 1.0, "=": 2.0, "#": 3.0, "$": 4.0, ":": 1.5, "/": 1.0, "\\": 1.0}


@dataclass(slots=True)
class Atom:
    symbol: str
    charge: int = 0
    hydrogens: int = 0
    aromatic: bool = False
    isotope: int = 0
    bracket: bool = False
    #: "@" or "@@" of the order in `around`: neighbours' indices, -1 for the hydrogen.
    chirality: str = ""
    around: list[int] = field(default_factory=list)

    def like(self, hydrogens: int, chirality: str, around: list[int]) -> Atom:
        return Atom(self.symbol, self.charge, hydrogens, self.aromatic, self.isotope, self.bracket, chirality, around)


@dataclass
class Molecule:
    atoms: list[Atom] = field(default_factory=list)
    #: (a, b) with a < b: order, 1.5 for aromatic.
    bonds: dict[tuple[int, int], float] = field(default_factory=dict)

    def neighbours(self) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in self.atoms]
        for a, b in self.bonds:
            out[a].append(b)
            out[b].append(a)
        return out

    def order(self, a: int, b: int) -> float:
        return self.bonds[(a, b) if a < b else (b, a)]


def parse_smiles(text: str | None, aromatize: bool = True) -> Molecule | None:
    """A molecule with its implicit hydrogens counted, or None for null and unreadable texts. Empty text: no atoms.

    Charges and radicals don't need `aromatize`, which finds aromatic rings that are written with double bonds.
    """
    if text is None:
        return None
    mol, stack, rings = Molecule(), [], {}
    last, order, at = -1, None, 0

    def bind(a: int, b: int, o: float | None) -> bool:
        key = (min(a, b), max(a, b))
        if a == b or key in mol.bonds:
            return False
        mol.bonds[key] = o if o is not None else 1.5 if mol.atoms[a].aromatic and mol.atoms[b].aromatic else 1.0
        return True

    while at < len(text):
        c = text[at]
        if c == "(":
            if last < 0:
                return None
            stack.append(last)
            at += 1
            continue
        if c == ")":
            if not stack or order is not None:
                return None
            last = stack.pop()
            at += 1
            continue
        if c == ".":
            if order is not None:
                return None
            last = -1
            at += 1
            continue
        if c in _ORDERS:
            if order is not None or last < 0:
                return None
            order = _ORDERS[c]
            at += 1
            continue
        if c.isascii() and (c.isdigit() or c == "%"):
            number = text[at : at + 1] if c != "%" else text[at + 1 : at + 3]
            if last < 0 or not number.isdigit() or (c == "%" and len(number) < 2):
                return None
            at += 1 if c != "%" else 3
            if number in rings:
                other, o, place = rings.pop(number)
                if o is not None and order is not None and o != order or not bind(other, last, o if order is None else order):
                    return None
                mol.atoms[other].around[place] = last
                mol.atoms[last].around.append(other)
            else:
                rings[number] = (last, order, len(mol.atoms[last].around))
                mol.atoms[last].around.append(-2)
            order = None
            continue
        m = _BRACKET.match(text, at) if c == "[" else _PLAIN.match(text, at)
        if not m:
            return None
        if c == "[":
            isotope, symbol, chirality, h, charge = m.groups()
            sign = 0 if not charge else int(charge) if len(charge) > 1 and charge[1].isdigit() else (1 if charge[0] == "+" else -1) * len(charge)
            atom = Atom(_AROMATIC.get(symbol, symbol), sign, 0 if h is None else int(h or 1), symbol in _AROMATIC, int(isotope or 0), True, chirality)
            if atom.symbol not in NUMBERS:
                return None
        else:
            atom = Atom(_AROMATIC.get(m.group(), m.group()), aromatic=m.group() in _AROMATIC)
        here = len(mol.atoms)
        mol.atoms.append(atom)
        if last >= 0:
            if not bind(last, here, order):
                return None
            mol.atoms[last].around.append(here)
            atom.around.append(last)
        if atom.chirality and atom.hydrogens:
            atom.around.append(-1)
        last, order, at = here, None, m.end()
    if stack or rings or order is not None:
        return None
    mol = _add_hydrogens(mol)
    return _aromatize(mol) if aromatize else mol


def _valence(mol: Molecule) -> list[float]:
    total = [0.0] * len(mol.atoms)
    ring = set()
    for (a, b), o in mol.bonds.items():
        total[a] += 1.0 if o == 1.5 else o
        total[b] += 1.0 if o == 1.5 else o
        if o == 1.5:
            ring |= {a, b}
    # An aromatic atom has one more bond than neighbours, but for those that give a pair of electrons.
    for i in ring:
        a = mol.atoms[i]
        total[i] += a.aromatic and a.symbol not in ("O", "S", "Se") and not (a.symbol in ("N", "P") and (a.bracket and a.hydrogens or total[i] >= 3))
    return total


def _add_hydrogens(mol: Molecule) -> Molecule:
    if any(not a.bracket for a in mol.atoms):
        for a, used in zip(mol.atoms, _valence(mol), strict=True):
            if not a.bracket:
                a.hydrogens = max(0, int(next((v for v in VALENCES[a.symbol] if v >= used), used) - used))
    return mol


def parse_block(block: str | None) -> Molecule | None:
    """The molecule of a valid V2000 block, all atoms explicit; None for others. Charges from M  CHG, else from the atom lines."""
    return _read_block(block.replace("\r\n", "\n").split("\n")) if is_block(block) else None


def _read_block(lines: list[str]) -> Molecule:
    n, m = int(lines[3][:3]), int(lines[3][3:6])
    mol = Molecule([Atom(x[31:34].strip(), CHARGE_CODES.get(int(x[36:39]), 0) if x[36:39].strip().isdigit() else 0, bracket=True) for x in lines[4 : 4 + n]])
    for x in lines[4 + n : 4 + n + m]:
        a, b, kind = int(x[:3]) - 1, int(x[3:6]) - 1, int(x[6:9])
        mol.bonds[(a, b) if a < b else (b, a)] = 1.5 if kind == 4 else float(kind)
    charges = [x[9:].split() for x in lines[4 + n + m :] if x.startswith("M  CHG")]
    if charges:
        for a in mol.atoms:
            a.charge = 0
        for pairs in charges:
            for i, q in zip(pairs[::2], pairs[1::2], strict=False):
                if i.isdigit() and 0 < int(i) <= n:
                    mol.atoms[int(i) - 1].charge = int(q)
    return mol


def _positions(lines: list[str], n: int, m: int) -> list[tuple[float, float, float]]:
    """Coordinates of the atom lines; in a flat drawing a wedged neighbour stands above the plane, a hashed one below."""
    at = [(float(x[:10]), float(x[10:20]), float(x[20:30])) for x in lines[4 : 4 + n]]
    if any(z for _, _, z in at):
        return at
    for x in lines[4 + n : 4 + n + m]:
        up = {"1": 1.0, "6": -1.0}.get(x[9:12].strip())
        if up:
            b = int(x[3:6]) - 1
            at[b] = (*at[b][:2], up)
    return at


def kekulize(mol: Molecule) -> bool:
    """Aromatic bonds of a block as single and double ones in place; False, with nothing changed, where they don't go in.

    Every atom of such a bond that has a free valence takes part in one double bond: a matching, found by growing paths.
    """
    near: dict[int, list[int]] = {}
    for (a, b), o in mol.bonds.items():
        if o == 1.5:
            near.setdefault(a, []).append(b)
            near.setdefault(b, []).append(a)
    used = dict.fromkeys(near, 0.0)
    for (a, b), o in mol.bonds.items():
        for i in (a, b):
            if i in used:
                used[i] += 1.0 if o == 1.5 else o

    def room(i: int) -> float:
        a = mol.atoms[i]
        shift = -abs(a.charge) if a.symbol == "C" else a.charge
        return VALENCES.get(a.symbol, (0,))[0] + shift - used[i] - a.hydrogens

    want = {i for i in near if room(i) >= 1}
    mate: dict[int, int] = {}

    def grow(i: int, seen: set[int]) -> bool:
        for j in near[i]:
            if j in want and j not in seen:
                seen |= {i, j}
                if j not in mate or grow(mate[j], seen):
                    mate[i], mate[j] = j, i
                    return True
        return False

    for i in sorted(want):
        if i not in mate and not grow(i, set()):
            return False
    for (a, b), o in mol.bonds.items():
        if o == 1.5:
            mol.bonds[(a, b)] = 2.0 if mate.get(a) == b else 1.0
    return True


def from_template(mol: Molecule, smiles: str | None) -> Molecule | None:
    """The block's molecule (hydrogens folded) with bonds, charges and aromatic marks of a SMILES of the same connections, or None."""
    other = parse_smiles(smiles, aromatize=False)
    if other is None:
        return None
    other = without_hydrogens(other)
    bare = lambda x: Molecule([Atom(a.symbol, isotope=a.isotope) for a in x.atoms], dict.fromkeys(x.bonds, 1.0))
    mine, theirs = bare(mol), bare(other)
    if len(mol.atoms) != len(other.atoms) or len(mol.bonds) != len(other.bonds) or sorted(a.symbol for a in mine.atoms) != sorted(a.symbol for a in theirs.atoms):
        return None
    here, there = ({r: i for i, r in enumerate(ranks(x))} for x in (mine, theirs))
    match = {i: here[r] for r, i in there.items()}
    bonds = {}
    for (a, b), o in other.bonds.items():
        key = (min(match[a], match[b]), max(match[a], match[b]))
        if key not in mol.bonds:
            return None
        bonds[key] = o
    atoms = list(mol.atoms)
    for i, a in enumerate(other.atoms):
        if atoms[match[i]].symbol != a.symbol:
            return None
        atoms[match[i]] = replace(a, hydrogens=max(a.hydrogens, atoms[match[i]].hydrogens), bracket=True, chirality="", around=[])
    return Molecule(atoms, bonds)


# Elements that are read as tetrahedral centres.
CENTRES = frozenset(("C", "Si", "Ge", "N", "P", "As", "S", "Se"))


def mark_centres(mol: Molecule, at: list[tuple[float, float, float]]) -> list[int] | None:
    """Sets "@" or "@@" on the tetrahedral centres of a molecule (hydrogens folded) from its atoms' positions.

    A centre has four neighbours of different classes, one of them at most a hydrogen. Four neighbours in one plane
    with it decide nothing. Returns the classes of the atoms if they had to be found.
    """
    near = mol.neighbours()
    able = [i for i, a in enumerate(mol.atoms) if a.symbol in CENTRES and not a.aromatic and len(near[i]) + a.hydrogens == 4 and a.hydrogens <= 1 and (a.symbol != "N" or a.charge == 1)]
    if not able:
        return None
    kind = classes(mol)
    for i in able:
        if len({kind[j] for j in near[i]}) < len(near[i]):
            continue
        around = [*([-1] if mol.atoms[i].hydrogens else []), *near[i]]
        (ax, ay, az), (bx, by, bz), (cx, cy, cz) = (tuple(p - q for p, q in zip(at[j], at[i], strict=True)) for j in around[1:])
        volume = ax * (by * cz - bz * cy) - ay * (bx * cz - bz * cx) + az * (bx * cy - by * cx)
        if abs(volume) > 1e-3:
            mol.atoms[i].chirality, mol.atoms[i].around = "@" if volume < 0 else "@@", around
    return kind


def without_hydrogens(mol: Molecule) -> Molecule:
    """Plain hydrogen atoms folded into their heavy neighbours."""
    near = mol.neighbours()
    gone = {i for i, a in enumerate(mol.atoms) if a.symbol == "H" and not a.charge and not a.isotope and len(near[i]) == 1 and mol.atoms[near[i][0]].symbol != "H"}
    if not gone:
        return mol
    place = {old: new for new, old in enumerate(i for i in range(len(mol.atoms)) if i not in gone)}
    atoms = []
    for i in place:
        a = mol.atoms[i]
        h = sum(j in gone for j in near[i])
        atoms.append(a.like(a.hydrogens + h, a.chirality, [-1 if j in gone else place.get(j, j) for j in a.around] if a.around else []))
    return Molecule(atoms, {(place[a], place[b]): o for (a, b), o in mol.bonds.items() if a in place and b in place})


def ring_bonds(mol: Molecule) -> set[tuple[int, int]]:
    """Bonds that lie in a ring: all that are no bridges."""
    near, seen, low, out = mol.neighbours(), {}, {}, set(mol.bonds)
    for root in range(len(mol.atoms)):
        if root in seen:
            continue
        seen[root] = low[root] = len(seen)
        stack = [(root, -1, iter(near[root]))]
        while stack:
            v, parent, rest = stack[-1]
            for w in rest:
                if w == parent:
                    continue
                if w in seen:
                    low[v] = min(low[v], seen[w])
                else:
                    seen[w] = low[w] = len(seen)
                    stack.append((w, v, iter(near[w])))
                    break
            else:
                stack.pop()
                if parent >= 0:
                    low[parent] = min(low[parent], low[v])
                    if low[v] > seen[parent]:
                        out.discard((min(v, parent), max(v, parent)))
    return out


def small_rings(mol: Molecule, most: int = 7) -> set[frozenset[int]]:
    """The smallest ring through each ring bond, up to `most` atoms."""
    inside = ring_bonds(mol)
    near: dict[int, list[int]] = {}
    for a, b in inside:
        near.setdefault(a, []).append(b)
        near.setdefault(b, []).append(a)
    rings = set()
    for a, b in inside:
        back, queue = {a: -1}, deque([(a, 1)])
        while queue and b not in back:
            v, n = queue.popleft()
            for w in near[v]:
                if w not in back and n < most and not (v == a and w == b):
                    back[w] = v
                    queue.append((w, n + 1))
        if b in back:
            ring, v = [], b
            while v >= 0:
                ring.append(v)
                v = back[v]
            rings.add(frozenset(ring))
    return rings


def _aromatize(mol: Molecule) -> Molecule:
    """Marks rings of five to seven atoms with 4n+2 pi electrons, whichever way their bonds were written."""
    if not any(o >= 1.5 for o in mol.bonds.values()):
        return mol
    near, rings = mol.neighbours(), [r for r in small_rings(mol) if len(r) >= 5]
    everywhere = set().union(*rings) if rings else set()
    for ring in rings:
        pi = 0
        for i in ring:
            a = mol.atoms[i]
            orders = {j: mol.order(i, j) for j in near[i]}
            doubles = [j for j, o in orders.items() if o == 2]
            if any(o == 3 for o in orders.values()) or len(doubles) > 1:
                break
            if a.aromatic or any(j in everywhere for j in doubles):
                lone = a.symbol in ("O", "S", "Se") or a.symbol == "N" and (a.hydrogens or len(near[i]) == 3) and not a.charge
                pi += 2 if lone and not doubles else 1
            elif doubles:
                if mol.atoms[doubles[0]].symbol not in ("O", "S", "N"):
                    break
            elif a.symbol in ("N", "O", "S", "Se") and a.charge == 0:
                pi += 2
            else:
                break
        else:
            if pi % 4 == 2:
                for i in ring:
                    mol.atoms[i].aromatic = True
                for i in ring:
                    for j in near[i]:
                        if j in ring and i < j:
                            mol.bonds[(i, j)] = 1.5
    return mol


def _bound(mol: Molecule) -> list[list[tuple[int, int]]]:
    """(neighbour, twice the order) of every atom."""
    out: list[list[tuple[int, int]]] = [[] for _ in mol.atoms]
    for (a, b), o in mol.bonds.items():
        k = int(2 * o)
        out[a].append((b, k))
        out[b].append((a, k))
    return out


def _refine(rank: list[int], bound: list[list[tuple[int, int]]]) -> list[int]:
    many = len(set(rank))
    while many < len(rank):
        rank = _dense([(r, *sorted([16 * rank[j] + k for j, k in x])) for r, x in zip(rank, bound, strict=True)])
        now = max(rank) + 1
        if now == many:
            break
        many = now
    return rank


def classes(mol: Molecule, bound: list[list[tuple[int, int]]] | None = None) -> list[int]:
    """Atoms of equal surroundings have equal numbers; marks of handedness don't count."""
    bound = bound or _bound(mol)
    in_ring = {i for bond in ring_bonds(mol) for i in bond}
    return _refine(_dense([(NUMBERS.get(a.symbol, 0), a.isotope, a.charge, a.hydrogens, len(bound[i]), a.aromatic, i in in_ring) for i, a in enumerate(mol.atoms)]), bound)


def ranks(mol: Molecule, stereo: bool = True, kinds: list[int] | None = None) -> list[int]:
    """A canonical rank for each atom: refinement over neighbours, remaining ties broken one after another.

    `kinds`: the result of classes(), where it is known.
    """
    n, bound = len(mol.atoms), _bound(mol)
    rank = _without_leaves(kinds or classes(mol, bound), bound)
    if stereo and max(rank, default=-1) + 1 < n and any(a.chirality for a in mol.atoms):
        signs = [_handedness(a, [(-1 if j == -1 else rank[j]) for j in a.around]) for a in mol.atoms]
        rank = _refine(_dense([(rank[i], signs[i]) for i in range(n)]), bound)
    while max(rank, default=-1) + 1 < n:
        seen: dict[int, int] = {}
        for r in rank:
            seen[r] = seen.get(r, 0) + 1
        tied = min(r for r, k in seen.items() if k > 1)
        pick = rank.index(tied)
        rank = _refine(_dense([(r, 0 if i == pick else 1) if r == tied else (r, 0) for i, r in enumerate(rank)]), bound)
    return rank


def _without_leaves(rank: list[int], bound: list[list[tuple[int, int]]]) -> list[int]:
    # Leaves of one kind at one neighbour may take any order; told apart at once they cost no refinement.
    alike: dict[tuple[int, int], list[int]] = {}
    class_size: dict[int, int] = {}
    for i, r in enumerate(rank):
        class_size[r] = class_size.get(r, 0) + 1
        if len(bound[i]) == 1:
            alike.setdefault((r, bound[i][0][0]), []).append(i)
    place = {i: k for (r, _), group in alike.items() if len(group) > 1 and len(group) == class_size[r] for k, i in enumerate(group)}
    return _refine(_dense([(r, place.get(i, 0)) for i, r in enumerate(rank)]), bound) if place else rank


def _dense(keys: list) -> list[int]:
    order = {k: i for i, k in enumerate(sorted(set(keys)))}
    return [order[k] for k in keys]


def _odd(order: list) -> bool:
    """Whether sorting takes an odd number of swaps."""
    return sum(a > b for i, a in enumerate(order) for b in order[i + 1 :]) % 2 == 1


def _handedness(a: Atom, around: list[int]) -> int:
    """+1 or -1 independent of the order of writing, 0 where neighbours are alike or there is no mark."""
    if not a.chirality or len(set(around)) < len(around) or len(around) != 4:
        return 0
    return (1 if a.chirality == "@" else -1) * (-1 if _odd(around) else 1)


def write_smiles(mol: Molecule, isomeric: bool = True, rank: list[int] | None = None) -> str:
    """Canonical SMILES: equal for equal molecules of this kernel. Double-bond geometry is not kept.

    `rank`: the result of ranks() for the same `isomeric`, where it is known.
    """
    rank, near = rank or ranks(mol, isomeric), mol.neighbours()
    parts, seen = [], set()
    for root in sorted(range(len(mol.atoms)), key=rank.__getitem__):
        if root not in seen:
            parts.append(_write_part(mol, root, rank, near, seen, isomeric))
    return ".".join(sorted(parts))


def _write_part(mol: Molecule, root: int, rank: list[int], near: list[list[int]], seen: set[int], isomeric: bool) -> str:
    # First a walk that finds tree edges and ring closures, then the writing; both without recursion.
    children: dict[int, list[int]] = {}
    parent = {root: -1}
    closures: dict[int, list[int]] = {}
    when: dict[int, int] = {}
    stack = [root]
    stack_iter = [iter(sorted(near[root], key=rank.__getitem__))]
    seen.add(root)
    when[root] = 0
    children[root] = []
    while stack:
        v = stack[-1]
        for w in stack_iter[-1]:
            if w == parent[v]:
                continue
            if w in when:
                if when[w] < when[v]:
                    closures.setdefault(w, []).append(v)
                    closures.setdefault(v, []).append(w)
                continue
            seen.add(w)
            when[w] = len(when)
            parent[w] = v
            children[v].append(w)
            children[w] = []
            stack.append(w)
            stack_iter.append(iter(sorted(near[w], key=rank.__getitem__)))
            break
        else:
            stack.pop()
            stack_iter.pop()
    out: list[str] = []
    free: list[int] = []
    digits: dict[tuple[int, int], int] = {}
    todo: list = [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
            continue
        v = x
        if parent[v] >= 0:
            out.append(_bond(mol, parent[v], v))
        ring = sorted(closures.get(v, []), key=lambda w: (when[w] > when[v], rank[w]))
        out.append(_atom(mol, v, [*([parent[v]] if parent[v] >= 0 else []), *([-1] if mol.atoms[v].hydrogens == 1 else []), *ring, *children[v]], isomeric, near[v]))
        for w in ring:
            key = (min(v, w), max(v, w))
            if key in digits:
                d = digits.pop(key)
                free.append(d)
            else:
                d = min(free) if free else len(digits) + 1
                while d in digits.values():
                    d += 1
                if d in free:
                    free.remove(d)
                digits[key] = d
                out.append(_bond(mol, v, w))
            out.append(str(d) if d < 10 else f"%{d:02d}")
        kids = children[v]
        for k, w in reversed(list(enumerate(kids))):
            todo += [w] if k == len(kids) - 1 else [")", w, "("]
    return "".join(out)


def _bond(mol: Molecule, a: int, b: int) -> str:
    o = mol.order(a, b)
    both = mol.atoms[a].aromatic and mol.atoms[b].aromatic
    return "-" if o == 1 and both else "" if o == 1 or o == 1.5 and both else {1.5: ":", 2: "=", 3: "#", 4: "$"}[o]


def _atom(mol: Molecule, v: int, order: list[int], isomeric: bool, near: list[int]) -> str:
    a = mol.atoms[v]
    mark = ""
    if isomeric and a.chirality and len(a.around) == 4 and sorted(a.around) == sorted(order):
        place = {x: i for i, x in enumerate(a.around)}
        flip = _odd([place[x] for x in order])
        mark = {"@": "@@", "@@": "@"}[a.chirality] if flip else a.chirality
    symbol = a.symbol.lower() if a.aromatic else a.symbol
    if a.symbol in VALENCES and not a.charge and not a.isotope and not mark and a.hydrogens == _implied(mol, v, near):
        return symbol
    h = "" if not a.hydrogens else "H" if a.hydrogens == 1 else f"H{a.hydrogens}"
    q = "" if not a.charge else ("+" if a.charge > 0 else "-") + (str(abs(a.charge)) if abs(a.charge) > 1 else "")
    return f"[{a.isotope or ''}{symbol}{mark}{h}{q}]"


def _implied(mol: Molecule, v: int, near: list[int]) -> int:
    a = mol.atoms[v]
    orders = [mol.order(v, j) for j in near]
    used = sum(1.0 if o == 1.5 else o for o in orders)
    used += a.aromatic and a.symbol not in ("O", "S", "Se") and 1.5 in orders and not (a.symbol in ("N", "P") and used >= 3)
    return max(0, int(next((x for x in VALENCES[a.symbol] if x >= used), used) - used))


def mirror(mol: Molecule) -> Molecule:
    """All tetrahedral marks swapped."""
    return Molecule([a.like(a.hydrogens, {"@": "@@", "@@": "@"}[a.chirality], a.around) if a.chirality else a for a in mol.atoms], mol.bonds)


def radicals(mol: Molecule) -> int:
    """Unpaired electrons of bracketed atoms: what their bonds fall short of the valence that their charge leaves."""
    total = 0
    for a, used in zip(mol.atoms, _valence(mol), strict=True):
        if not a.bracket or a.symbol not in VALENCES_IN_BRACKETS:
            continue
        used += a.hydrogens
        kinds = VALENCES_IN_BRACKETS[a.symbol]
        if a.symbol in ("B", "Al"):
            allowed = [v - a.charge for v in kinds]
        elif a.symbol in ("C", "Si", "Ge", "H"):
            allowed = [v - abs(a.charge) for v in kinds]
        else:
            allowed = [v + a.charge for v in kinds]
        want = next((v for v in allowed if v >= used), None)
        total += int(want - used) if want is not None else 0
    return total


def charges(mol: Molecule) -> tuple[int, int]:
    """(net charge, atoms with a charge)."""
    return sum(a.charge for a in mol.atoms), sum(a.charge != 0 for a in mol.atoms)


def fragments(mol: Molecule) -> int:
    near, seen, n = mol.neighbours(), set(), 0
    for i in range(len(mol.atoms)):
        if i not in seen:
            n += 1
            todo = [i]
            while todo:
                v = todo.pop()
                if v not in seen:
                    seen.add(v)
                    todo += near[v]
    return n


def weight(mol: Molecule) -> float | None:
    """Molecular weight with all hydrogens; None where an element's weight is not known here."""
    try:
        return sum(WEIGHTS[a.symbol] + a.hydrogens * WEIGHTS["H"] for a in mol.atoms)
    except KeyError:
        return None


def polar_surface(mol: Molecule) -> float:
    """Topological polar surface of nitrogen and oxygen; kinds not in the table count by the published rule of thumb."""
    near, three = mol.neighbours(), {i for r in small_rings(mol, 3) for i in r}
    total = 0.0
    for i, a in enumerate(mol.atoms):
        if a.symbol not in ("N", "O"):
            continue
        orders = [mol.order(i, j) for j in near[i]]
        kinds = tuple(sum(o == k for o in orders) for k in (1, 2, 3, 1.5))
        found = POLAR_IN_THREE_RING.get((a.symbol, a.hydrogens)) if i in three and not a.charge and kinds == (2 + (a.symbol == "N" and not a.hydrogens), 0, 0, 0) else POLAR.get((a.symbol, a.hydrogens, a.charge, *kinds))
        if found is None:
            base, bonds = (30.5, 8.2) if a.symbol == "N" else (28.5, 8.6)
            found = max(0.0, base - (sum(orders) + a.hydrogens) * bonds + 1.5 * a.hydrogens)
        total += found
    return total


def rotatable(mol: Molecule) -> int:
    """Single bonds outside rings between atoms with two or more heavy neighbours each, none of them triply bound."""
    near, inside = mol.neighbours(), ring_bonds(mol)
    heavy = [sum(mol.atoms[j].symbol != "H" for j in near[i]) for i in range(len(mol.atoms))]
    triple = {i for bond, o in mol.bonds.items() if o == 3 for i in bond}
    return sum(o == 1 and bond not in inside and all(heavy[i] > 1 and i not in triple for i in bond) for bond, o in mol.bonds.items())


# Published contributions of atoms to the partition coefficient, by the names of the published types.
PARTITION = {
    "C1": 0.1441, "C2": 0.0, "C3": -0.2035, "C4": -0.2051, "C5": -0.2783, "C6": 0.1551, "C7": 0.0017, "C8": 0.08452, "C9": -0.1444,
    "C10": -0.0516, "C11": 0.1193, "C12": -0.0967, "C13": -0.5443, "C14": 0.0, "C15": 0.245, "C16": 0.198, "C17": 0.0, "C18": 0.1581,
    "C19": 0.2955, "C20": 0.2713, "C21": 0.136, "C22": 0.4619, "C23": 0.5437, "C24": 0.1893, "C25": -0.8186, "C26": 0.264, "C27": 0.2148, "CS": 0.08129,
    "H1": 0.123, "H2": -0.2677, "H3": 0.2142, "H4": 0.298, "HS": 0.1125,
    "N1": -1.019, "N2": -0.7096, "N3": -1.027, "N4": -0.5188, "N5": 0.08387, "N6": 0.1836, "N7": -0.3187, "N8": -0.4458, "N9": 0.01508, "N10": -1.95,
    "N11": -0.3239, "N12": -1.119, "N13": -0.3396, "N14": 0.2887, "NS": -0.4806,
    "O1": 0.1552, "O2": -0.2893, "O3": -0.0684, "O4": -0.4195, "O5": 0.0335, "O6": -0.3339, "O7": -1.189, "O8": 0.1788, "O9": -0.1526, "O10": 0.1129,
    "O11": 0.4833, "O12": -1.326, "OS": -0.1188,
    "F": 0.4202, "Cl": 0.6895, "Br": 0.8456, "I": 0.8857, "Hal": -2.996, "P": 0.8612, "S1": 0.6482, "S2": -0.0024, "S3": 0.6237, "Me1": -0.3808, "Me2": -0.0025,
}
_HALOGENS = ("F", "Cl", "Br", "I")
_POLAR_ATOMS = frozenset(("N", "O", "P", "S", *_HALOGENS))


def partition(mol: Molecule) -> float:
    """logP as the sum of published atom contributions (Wildman and Crippen); every hydrogen counts with its atom."""
    bound = [[(j, k) for j, k in x if mol.atoms[j].symbol != "H"] for x in _bound(mol)]
    explicit = [a.hydrogens + sum(mol.atoms[j].symbol == "H" for j, _ in x) for a, x in zip(mol.atoms, _bound(mol), strict=True)]
    total = 0.0
    for i, a in enumerate(mol.atoms):
        if a.symbol == "H" and any(j != i for j, _ in _bound(mol)[i]):
            continue
        kind, hydrogen = _kinds(mol, i, bound, explicit)
        total += PARTITION[kind] + explicit[i] * PARTITION[hydrogen]
    return total


def _kinds(mol: Molecule, i: int, bound: list[list[tuple[int, int]]], hydrogens: list[int]) -> tuple[str, str]:
    """Published types of an atom and of its hydrogens."""
    a, near, h = mol.atoms[i], bound[i], hydrogens[i]
    sym = lambda j: mol.atoms[j].symbol
    arom = lambda j: mol.atoms[j].aromatic
    doubles, triples = [j for j, k in near if k == 4], [j for j, k in near if k == 6]
    if a.symbol == "C":
        return _carbon(mol, a, near, h, doubles, triples), "H1"
    if a.symbol == "N":
        return _nitrogen(a, near, h, doubles, triples, arom), "H3"
    if a.symbol == "O":
        return _oxygen(mol, a, near, h, doubles, bound, hydrogens)
    if a.symbol in _HALOGENS:
        return ("Hal" if a.charge or not near else a.symbol), "H2"
    if a.symbol == "S":
        return ("S3" if a.aromatic else "S2" if a.charge or any(sym(j) in _POLAR_ATOMS for j in doubles) else "S1"), "H2"
    if a.symbol == "P":
        return "P", "H2"
    if a.symbol == "H":
        return ("H1" if not near or sym(near[0][0]) in ("C", "H") else "HS"), "H1"
    main = a.symbol in ("Li", "Be", "B", "Na", "Mg", "Al", "Si", "K", "Ca", "Ga", "Ge", "As", "Se", "Rb", "Sr", "In", "Sn", "Sb", "Te", "Cs", "Ba", "Pb", "Bi")
    return ("Me1" if main else "Me2"), "H2"


def _carbon(mol: Molecule, a: Atom, near: list, h: int, doubles: list[int], triples: list[int]) -> str:
    sym = lambda j: mol.atoms[j].symbol
    arom = lambda j: mol.atoms[j].aromatic
    if a.aromatic:
        outside = [(j, k) for j, k in near if k != 3]
        if h:
            return "C18"
        if not outside:
            return "C19" if len(near) == 3 else "CS"
        j, k = outside[0]
        if k == 4:
            return "C25" if sym(j) in ("C", "N", "O") else "CS"
        if sym(j) in _HALOGENS:
            return {"F": "C14", "Cl": "C15", "Br": "C16", "I": "C17"}[sym(j)]
        if arom(j):
            return "C20"
        return {"C": "C21", "N": "C22", "O": "C23", "S": "C24"}.get(sym(j), "C13")
    if triples or len(doubles) == 2:
        return "C7" if triples else "C5" if any(sym(j) != "C" for j in doubles) else "C6"
    if doubles:
        if sym(doubles[0]) != "C":
            return "C5"
        return "C26" if arom(doubles[0]) or any(arom(j) for j, k in near if k == 2) else "C6"
    if len(near) + h != 4:
        return "CS"
    attached = [j for j, _ in near]
    if any(arom(j) for j in attached):
        if h == 3:
            return "C8" if sym(attached[0]) == "C" else "C9"
        return {2: "C10", 1: "C11", 0: "C12"}[h]
    if any(sym(j) in _POLAR_ATOMS for j in attached):
        return "C3" if h >= 2 else "C4"
    if all(sym(j) == "C" for j in attached):
        return "C1" if h >= 2 else "C2"
    return "C27"


def _nitrogen(a: Atom, near: list, h: int, doubles: list[int], triples: list[int], arom) -> str:  # noqa: ANN001
    if a.aromatic:
        return "N12" if a.charge > 0 else "N11"
    if a.charge > 0:
        if h:
            return "N10"
        return "N14" if triples or len(doubles) == 2 else "N13"
    if a.charge < 0:
        return "N14" if doubles or triples else "NS"
    if triples:
        return "N9"
    if doubles:
        return "N5" if h else "N6"
    ring = any(arom(j) for j, _ in near)
    if h >= 2:
        return "N3" if ring else "N1"
    if h == 1:
        return "N4" if ring else "N2"
    return ("N8" if ring else "N7") if len(near) == 3 else "NS"


def _oxygen(mol: Molecule, a: Atom, near: list, h: int, doubles: list[int], bound: list, hydrogens: list[int]) -> tuple[str, str]:
    sym = lambda j: mol.atoms[j].symbol
    arom = lambda j: mol.atoms[j].aromatic
    if a.aromatic:
        return "O1", "H2"
    if h:
        # An acid's hydrogen stands apart from an alcohol's.
        j = near[0][0] if near else -1
        acid = j >= 0 and not arom(j) and (sym(j) == "C" and any(k == 4 and sym(x) in ("C", "N", "O", "S") for x, k in bound[j]) or sym(j) in ("O", "S"))
        return "O2", "H3" if j >= 0 and sym(j) == "N" else "H4" if acid else "H2"
    if a.charge < 0 and near:
        j = near[0][0]
        if sym(j) == "C" and any(k == 4 and sym(x) == "O" for x, k in bound[j]):
            return "O12", "H2"
        return {"N": "O5", "S": "O6"}.get(sym(j), "O7"), "H2"
    if doubles:
        j = doubles[0]
        if sym(j) in ("N", "O"):
            return "O5", "H2"
        if sym(j) == "S":
            return "O6", "H2"
        if sym(j) != "C":
            return "O7", "H2"
        if arom(j):
            return "O8", "H2"
        others = [x for x, _ in bound[j] if mol.atoms[x] is not a]
        polar = sum(sym(x) != "C" for x in others)
        if polar == 2 or polar == 1 and hydrogens[j] == 0 and len(others) == 1:
            return "O11", "H2"
        return ("O10" if any(arom(x) for x in others) else "O9"), "H2"
    if len(near) == 2:
        return ("O4" if any(arom(j) for j, _ in near) else "O3"), "H2"
    return "OS", "H2"


def fingerprint(mol: Molecule, bits: int = 2048, radius: int = 2) -> list[int]:
    """Circular fingerprint as 64-bit words: environments of up to `radius` bonds around every atom, hashed."""
    import xxhash

    near, inside = mol.neighbours(), ring_bonds(mol)
    in_ring = {i for bond in inside for i in bond}
    h = lambda x: xxhash.xxh64_intdigest(repr(x))
    ids = [h((NUMBERS.get(a.symbol, 0), len(near[i]), a.hydrogens, a.charge, a.isotope, i in in_ring)) for i, a in enumerate(mol.atoms)]
    found, reach, known = set(ids), [frozenset()] * len(ids), set()
    for _ in range(radius):
        new = [h((ids[i], sorted((mol.order(i, j), ids[j]) for j in near[i]))) for i in range(len(ids))]
        grown = [frozenset({(min(i, j), max(i, j)) for j in near[i]}.union(reach[i], *(reach[j] for j in near[i]))) for i in range(len(ids))]
        # An environment that covers the same bonds as an earlier one says nothing new.
        for i in sorted(range(len(ids)), key=lambda i: new[i]):
            if near[i] and grown[i] not in known:
                known.add(grown[i])
                found.add(new[i])
        ids, reach = new, grown
    words = [0] * (bits // 64)
    for x in found:
        b = x % bits
        words[b // 64] |= 1 << (b % 64)
    return [w - (1 << 64) if w >> 63 else w for w in words]


@lru_cache(maxsize=20_000)
def smiles_facts(text: str) -> tuple | None:
    """(canonical, flat, mirrored, stereo, net charge, charged atoms, radicals, fragments, weight, polar surface, rotatable, atoms, logP) or None."""
    mol = parse_smiles(text)
    if mol is None:
        return None
    canonical, flat, mirrored, has = texts(mol)
    net, charged = charges(mol)
    return (
        canonical, flat if flat else write_smiles(mol, isomeric=False), mirrored, has,
        net, charged, radicals(mol), fragments(mol), weight(mol), polar_surface(mol), rotatable(mol), len(mol.atoms), partition(mol),
    )


def texts(mol: Molecule, kinds: list[int] | None = None) -> tuple[str, str | None, str, bool]:
    """(canonical, the same without stereo if there is none, mirrored, whether there is stereo)."""
    kinds = kinds or classes(mol)
    canonical = write_smiles(mol, rank=ranks(mol, kinds=kinds))
    if not any(a.chirality for a in mol.atoms):
        return canonical, canonical, canonical, False
    settled = _without_leaves(kinds, _bound(mol))
    if max(settled, default=-1) + 1 == len(mol.atoms):
        # Handedness had no say in the ranks: the mirror image is written in the same order, with all marks swapped.
        return canonical, None, canonical.replace("@@", "\0").replace("@", "@@").replace("\0", "@"), True
    other = mirror(mol)
    return canonical, None, write_smiles(other, rank=ranks(other, kinds=kinds)), True


@lru_cache(maxsize=20_000)
def smiles_state(text: str) -> tuple[int, int, int] | None:
    """(net charge, charged atoms, radicals) or None: what a filter of chemical states needs, without rings and texts."""
    mol = parse_smiles(text, aromatize=False)
    return None if mol is None else (*charges(mol), radicals(mol))


@lru_cache(maxsize=20_000)
def smiles_composition(text: str | None) -> dict[str, int]:
    """Atoms of each element of a SMILES text, hydrogens among them; empty for null and unreadable ones."""
    mol = parse_smiles(text, aromatize=False)
    found: dict[str, int] = {}
    for a in mol.atoms if mol else ():
        found[a.symbol] = found.get(a.symbol, 0) + 1
        if a.hydrogens:
            found["H"] = found.get("H", 0) + a.hydrogens
    return found


@lru_cache(maxsize=20_000)
def flat_smiles(text: str) -> str | None:
    """Canonical text without stereo, or None."""
    mol = parse_smiles(text)
    return None if mol is None else write_smiles(mol, isomeric=False)


def _structure(lines: list[str], smiles: str | None = None) -> tuple[Molecule, Molecule | None, str | None]:
    """(molecule with all atoms, the same with folded hydrogens and whole bonds, why that failed) of a valid block's lines."""
    mol = _read_block(lines)
    whole = all(o != 1.5 for o in mol.bonds.values()) or kekulize(mol)
    heavy = without_hydrogens(mol)
    if whole:
        return mol, heavy, None
    if not smiles:
        return mol, None, "kekulize failed, no SMILES for template"
    heavy = from_template(heavy, smiles)
    if heavy is None:
        return mol, None, "SMILES tag unparseable" if parse_smiles(smiles, aromatize=False) is None else "template fallback failed"
    return mol, heavy, None


def block_texts(block: str | None, smiles: str | None = None) -> tuple | None:
    """(canonical, mirrored, stereo, net charge, charged atoms, radicals, fragments, symbols, bonds, why there is no text) of a valid block.

    Canonical text and handedness come from bonds and coordinates (a flat drawing's wedges). Aromatic bonds that can't
    be written as single and double ones are taken from `smiles` if it has the same connections; else texts are None.
    """
    if not is_block(block):
        return None
    lines = block.rstrip("\r\n").replace("\r\n", "\n").split("\n")
    mol, heavy, why = _structure(lines, smiles)
    net, charged = charges(mol)
    facts = (net, charged, radicals(mol), fragments(mol), [a.symbol for a in mol.atoms], len(mol.bonds), why)
    if heavy is None:
        return (None, None, False, *facts)
    heavy = _aromatize(heavy)
    at = _positions(lines, len(mol.atoms), len(mol.bonds))
    kinds = mark_centres(heavy, [at[i] for i in _kept(mol)])
    canonical, _, mirrored, has = texts(heavy, kinds)
    return (canonical, mirrored, has, *facts)


def block_flat(block: str | None) -> str | None:
    """Canonical text of a valid block without stereo, from its own bonds; None for others."""
    mol = parse_block(block)
    return None if mol is None else write_smiles(_aromatize(without_hydrogens(mol)), isomeric=False)


def reorder_block(block: str | None, smiles: str | None = None, by_rank: bool = False) -> str | None:
    """The block with its atoms in canonical order, bonds renumbered and sorted; null for no valid block.

    Hydrogens that count with a heavy atom follow behind all others, in the order of their atoms. Bonds that a template
    had to give are written as it gives them. With `by_rank` the ranks themselves are taken for the order, as some
    pipelines did: atom i of the result is the one whose number is the rank of atom i.
    """
    if not is_block(block):
        return None
    lines = block.rstrip("\r\n").replace("\r\n", "\n").split("\n")
    n, m = int(lines[3][:3]), int(lines[3][3:6])
    mol, heavy, _ = _structure(lines, smiles)
    if heavy is None:
        heavy = without_hydrogens(mol)
    kept = _kept(mol)
    at = _positions(lines, n, m)
    drawn = any(x[6:9].strip() == "4" for x in lines[4 + n : 4 + n + m])
    written = {(kept[a], kept[b]): o for (a, b), o in heavy.bonds.items()} if drawn else {}
    heavy = _aromatize(heavy)
    mark_centres(heavy, [at[i] for i in kept])
    place = dict(zip(kept, ranks(heavy), strict=True))
    near = mol.neighbours()
    order = sorted(range(n), key=lambda i: (0, place[i], i) if i in place else (1, place[near[i][0]], i))
    if by_rank:
        order = [new for _, new in sorted((old, new) for new, old in enumerate(order))]
    return _renumbered(lines, order, written)


def _renumbered(lines: list[str], order: list[int], written: dict[tuple[int, int], float]) -> str:
    """A block with its atoms in `order`; orders of bonds in `written` replace those of the block."""
    n, m = len(order), int(lines[3][3:6])
    new = {old: i + 1 for i, old in enumerate(order)}
    bonds = []
    for x in lines[4 + n : 4 + n + m]:
        a, b = int(x[:3]) - 1, int(x[3:6]) - 1
        o = written.get((min(a, b), max(a, b)))
        # A wedge belongs to the atom it starts from, so only plain bonds are written from the lower number.
        pair = (new[a], new[b]) if x[9:12].strip() in ("1", "6") else tuple(sorted((new[a], new[b])))
        bonds.append((pair, (f"{4 if o == 1.5 else int(o):3d}" if o else x[6:9]) + x[9:]))
    rest = []
    for x in lines[4 + n + m :]:
        if x.startswith(("M  CHG", "M  RAD", "M  ISO")):
            pairs = x[9:].split()
            x = x[:9] + "".join(f" {new[int(i) - 1]:3d} {q:>3s}" for i, q in zip(pairs[::2], pairs[1::2], strict=False))
        rest.append(x)
    return "\n".join([*lines[:4], *[lines[4 + i] for i in order], *[f"{a:3d}{b:3d}{tail}" for (a, b), tail in sorted(bonds)], *rest])


def order_by_elements(block: str, symbols: list[str]) -> str | None:
    """The block with its atoms in an order known by elements alone: each takes the next atom of its element. None if they don't match."""
    if not is_block(block):
        return None
    lines = block.rstrip("\r\n").replace("\r\n", "\n").split("\n")
    waiting: dict[str, list[int]] = {}
    for i, x in enumerate(lines[4 : 4 + int(lines[3][:3])]):
        waiting.setdefault(x[31:34].strip(), []).append(i)
    if sorted(symbols) != sorted(e for e, places in waiting.items() for _ in places):
        return None
    turns = {e: iter(places) for e, places in waiting.items()}
    return _renumbered(lines, [next(turns[e]) for e in symbols], {})


def _kept(mol: Molecule) -> list[int]:
    """Atoms that without_hydrogens keeps, in their order."""
    near = mol.neighbours()
    return [i for i, a in enumerate(mol.atoms) if not (a.symbol == "H" and not a.charge and not a.isotope and len(near[i]) == 1 and mol.atoms[near[i][0]].symbol != "H")]


# Covalent radii in angstrom.
RADII = {"H": 0.31, "B": 0.84, "C": 0.76, "N": 0.71, "O": 0.66, "F": 0.57, "Si": 1.11, "P": 1.07, "S": 1.05, "Cl": 1.02, "Se": 1.20, "Br": 1.20, "I": 1.39}
#: Angstrom beyond the sum of radii up to which two atoms are bound.
SLACK = 0.40


def bonds_from_geometry(block: str | None, charge: int = 0) -> Molecule | None:
    """The molecule of a block with bonds and charges worked out from its coordinates and total charge.

    Atoms nearer than their covalent radii allow are bound; free valences of neighbours become double and triple bonds,
    the least connected atoms first; the charge goes to atoms whose valence calls for one. None for unreadable blocks,
    for elements without a radius, and where valences and charge cannot be met: the block's own bonds then have to do.
    """
    mol = parse_block(block)
    if mol is None or any(a.symbol not in RADII for a in mol.atoms):
        return None
    lines = block.replace("\r\n", "\n").split("\n")
    at = [tuple(float(x[i : i + 10]) for i in (0, 10, 20)) for x in lines[4 : 4 + len(mol.atoms)]]
    # A grid of cells as wide as the longest bond, so that only near atoms are compared.
    cells: dict[tuple[int, ...], list[int]] = {}
    for i, p in enumerate(at):
        cells.setdefault(tuple(int(c // 3.2) for c in p), []).append(i)
    out = Molecule([replace(a, charge=0) for a in mol.atoms])
    for (x, y, z), own in cells.items():
        close = [j for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1) for j in cells.get((x + dx, y + dy, z + dz), ())]
        for i in own:
            for j in close:
                if i < j and sum((a - b) ** 2 for a, b in zip(at[i], at[j], strict=True)) <= (RADII[mol.atoms[i].symbol] + RADII[mol.atoms[j].symbol] + SLACK) ** 2:
                    out.bonds[(i, j)] = 1.0
    near = out.neighbours()
    least = [VALENCES_IN_BRACKETS[a.symbol][0] for a in out.atoms]
    free = []
    for i, a in enumerate(out.atoms):
        kinds = [v for v in VALENCES_IN_BRACKETS[a.symbol] if v >= len(near[i])]
        if not kinds and a.symbol == "N" and len(near[i]) == 4:
            a.charge, kinds = 1, [4]
        if not kinds:
            return None
        free.append(kinds[0] - len(near[i]))
    for _ in range(2):
        for i in sorted(range(len(free)), key=lambda i: (sum(free[j] > 0 for j in near[i]), least[i], i)):
            open_ = [j for j in near[i] if free[j] > 0]
            if free[i] > 0 and open_:
                j = min(open_, key=lambda j: (sum(free[k] > 0 for k in near[j]), j))
                key = (min(i, j), max(i, j))
                if out.bonds[key] < 3:
                    out.bonds[key] += 1
                    free[i] -= 1
                    free[j] -= 1
    for i, a in enumerate(out.atoms):
        # A lone valence of an electronegative atom is a negative charge, as far as the total still asks for one.
        if free[i] == 1 and a.symbol in ("O", "S", "N") and sum(b.charge for b in out.atoms) > charge:
            a.charge, free[i] = -1, 0
    return out if sum(a.charge for a in out.atoms) == charge else None
