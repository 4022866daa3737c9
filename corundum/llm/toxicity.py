"""Abusive, hateful or sexual content by compression distance.

Two zstandard dictionaries are trained apart, one on windows of text that raters marked, one on ordinary windows. A
window's score is the share of its compressed length that the first saves against the second; a document's score is
that of its worst window, so one abusive sentence inside a long harmless text counts in full.

Raters mark documents, not sentences, and err. A window therefore trains by the votes of the other labelled documents
that share its word triples: with clearly more marked than unmarked ones it may train the first dictionary, if its own
document is marked, and in no case the second. It then does if the dictionaries of the other half of the documents
find it closer to marked text. A few sentences written for this module join both sides, so that small samples know
something of either kind and of several languages.

Labelled documents are no fair sample: raters see more abusive ones than there are. The threshold is therefore set on the
scores of all documents, with the held-out scores of the marked ones: see calibrate.

Every document is scored whole. The labelled sample that trains is bounded by MAX_LABELLED documents.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import log

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from corundum.session import materialise, spread

#: Bound of the sample that trains: labelled documents, the first by a hash of their id, up to so many characters.
MAX_LABELLED = 12_000
MAX_CHARS = 32_000_000
#: Bytes of each dictionary at most, and length of the pieces that zstandard's training counts.
DICTIONARY_BYTES = 1 << 18
PIECE = 8
#: Length of the segments it picks: a 200th of the dictionary, within these bounds.
SEGMENTS, SEGMENT_LEAST, SEGMENT_MOST = 200, 50, 200
#: Share of its bytes up to which a window compressed by a dictionary counts as known to it.
KNOWN = 0.25
#: Times a window counts in training at most.
REPEATS = 20
LEVEL = 19
WINDOW_WORDS, WINDOW_STEP = 24, 12
#: Signs of a word from which it is scored in pieces, and their step.
WORD_CHARS, WORD_STEP = 120, 60
#: Shares saved from which a window of a marked document trains as marked, and from which one of an unmarked one doesn't train.
MINED, MISSED = 0.1, 0.3
#: Shares of marked documents above which a window may train as marked and above which one of an unmarked document is
#: suspect, and the documents each word triple starts from.
MAYBE, SUSPECT, PRIOR = 0.5, 0.8, 2.0
#: Thresholds to choose from; the last one holds where no document is marked.
GRID = tuple(i / 100 for i in range(4, 61))
#: Share of marked documents that a threshold must find to say something of the share of abusive documents.
TELLING = 0.3
#: Compressed bytes below which a window counts as that long: a saving of two or three bytes says nothing.
SHORT = 24
SEED = 41

# Training sentences written for this module. One a line.
SEED_MARKED = """
you are a stupid idiot and everybody hates you
shut up, you worthless piece of shit
you are such a pathetic loser, moron, dumbass
fuck you and fuck your work, asshole
you fucking bastard, you stupid bitch, you filthy whore
go kill yourself, nobody would miss you
i will find you and break your legs
i will come to your house and hurt you and your family
you should be shot, i hope you die
watch your back, next time you will bleed
you people are all retarded cowards
he is a dickhead and a wanker, she is a dirty slut
those immigrants are vermin and parasites, deport them all
all women are too dumb for this work and belong in the kitchen
black people are subhuman animals
gay people are a disease and should be wiped out
muslims, jews and christians like them should be banned from here
the world would be better without them, get rid of the whole race
disabled people are a burden and should not be born
suck my dick, spread your legs, show me your tits
send me your nude pictures, i want to see you naked
i want to lick your pussy and fuck you all night
she moaned while he thrust his cock into her mouth
come to my hotel room, baby, i will make you scream
hot girls want sex with you tonight, click here
take off your clothes for me, slowly
du bist ein dummer idiot, halt die fresse, du arschloch
verpiss dich, du wertloses stück scheiße, du hurensohn
ausländer raus, dieses gesindel ist ungeziefer
ich mache dich fertig, ich weiß wo du wohnst
zieh dich aus und zeig mir deine brüste
tu es un imbécile, ferme ta gueule, connard
va te faire foutre, sale pute, espèce de merde
les étrangers sont de la vermine, qu'on les chasse
je vais te casser la gueule, je sais où tu habites
montre-moi tes seins, déshabille-toi
eres un idiota inútil, cállate, hijo de puta
vete a la mierda, cabrón, das asco
los inmigrantes son basura y hay que echarlos
te voy a romper la cara, sé dónde vives
quítate la ropa y enséñame las tetas
你是个白痴，滚，废物
去死吧，没人喜欢你，蠢货
外国人都是垃圾，应该赶走
我要打断你的腿，我知道你住哪里
把衣服脱了，给我看你的身体
"""

SEED_ORDINARY = """
this stupid script is crap, the damn build broke again
what a shitty parser, i hate this fucking optimizer
my own dumb mistake, i am an idiot, sorry everyone
kill the process and abort the child job
the naked ion, the bare nucleus and the stripped atoms
the homo lies below the lumo
the report on harassment says that insults were removed
the policy forbids hate speech, threats and sexual harassment
the moderators deleted a post that insulted foreigners
a study of abusive language in online forums
the breast cancer screen and the sexual reproduction of yeast
the master and slave node, the dirty flag, the dead worker
the parasite assay kills the vermin strain
der blöde rechner ist schon wieder abgestürzt, so ein mist
ce foutu programme plante encore, quelle merde
este maldito programa se ha vuelto a colgar
这个破程序又崩溃了，真烦
"""

# Letters of other alphabets that look like Latin ones, and signs written for letters.
LOOKALIKES = str.maketrans("аеорсухіјѕһԁӏմոԛԝαοτνκβ", "aeopcyxijshdlunqwaotvkb")
WRITTEN_FOR = str.maketrans("0134578@$!|€£", "oieastbasiiel")

_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_]([ ._*\-]))(?:[^\W\d_]\1){2,}[^\W\d_](?![^\W_])")
_DOTTED = re.compile(r"(?<![^\W_])([._*\-]?)(?:[^\W\d_]([._*\-]))(?:[^\W\d_]\2){2,}[^\W\d_](?![^\W_])(?:\2(?=\s+[._*\-]?[^\W\d_A-Z]))?")
_RUN = re.compile(r"([^\W\d_])\1{2,}")
_MIXED = re.compile(r"[^\W_0-9]*[0-9@$!|€£*][\w@$!|€£*]*")
_NUMBER = re.compile(r"[0-9]+(?:[.,][0-9]+)*")
_INVISIBLE = re.compile("[­​-‏⁠﻿̀-ͯ]")
_END = re.compile(r"(?<=[.!?…])[\"')\]]*\s+|[\r\n]+|(?<=[。！？；])")
_WORD = re.compile(r"[぀-ヿ㐀-鿿]|[^\s぀-ヿ㐀-鿿]+")
_LATIN = re.compile("[a-z]")
_SYMBOLS = re.compile("[\U0001F000-\U0001FAFF\u2600-\u27BF\uFE0F]")


def _plain_word(m: re.Match) -> str:
    word = m.group()
    letters = sum(c.isalpha() for c in word)
    # Names with a number in them, such as ids, stay: only words that are mostly letters are read through.
    if letters * 2 < len(word) or letters < 2 or word[-1].isdigit() and word[:-1].isalpha() or word.rstrip("!").isalpha():
        return word
    return word.translate(WRITTEN_FOR)


def _join_letters(m: re.Match) -> str:
    joined = m.group().replace(m.group(1), "")
    # A leading article is as likely as a first letter, and costs a word less if wrong.
    return f"a {joined[1:]}" if joined[0] == "a" and m.group(1) == " " else joined


def _join_signs(m: re.Match) -> str:
    return m.group().replace(m.group(2), "")


def plain(text: str) -> str:
    """A window without disguise: lower case, no marks and invisible signs, look-alikes and signs read as letters,
    letters set apart joined, runs of a letter cut to one, numbers as 0."""
    text = _INVISIBLE.sub("", unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text))).lower()
    if not text.isascii():
        text = " ".join(w.translate(LOOKALIKES) if _LATIN.search(w) or all(ord(c) >= 0x370 for c in w if c.isalpha()) and not _LATIN.search(w) and w.translate(LOOKALIKES).isascii() else w for w in text.split(" "))
    text = _SPACED.sub(_join_letters, _SYMBOLS.sub("", text))
    text = _MIXED.sub(_plain_word, text)
    return _NUMBER.sub("0", _RUN.sub(r"\1", text)).strip()


def _sentences(text: str | None) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """(sentence or line without disguise, spans of its words)."""
    # Words spelt with signs between the letters are joined first, where a dot before a blank would end a sentence. The
    # dot behind such a word ends one still if a capital follows.
    for part in _END.split(_DOTTED.sub(_join_signs, text or "")):
        if part and not part.isspace():
            flat = plain(part)
            yield flat, [m.span() for m in _WORD.finditer(flat)]


def _pieces(text: str | None) -> tuple[list[str], list[str]]:
    """(windows, word windows) of a text, which is read once for both."""
    found: dict[str, None] = {}
    words: dict[str, None] = {}
    for flat, spans in _sentences(text):
        for a, b in spans:
            if b - a > WORD_CHARS:
                words.update((flat[i : min(b, i + WORD_CHARS)], None) for i in range(a, b - WORD_CHARS + WORD_STEP, WORD_STEP))
            elif len(spans) == 1:
                words[flat[a:b]] = None
        if len(spans) < 2:
            continue
        for i in range(0, max(1, len(spans) - WINDOW_WORDS + WINDOW_STEP), WINDOW_STEP):
            piece = spans[i : i + WINDOW_WORDS]
            found[flat[piece[0][0] : piece[-1][1]]] = None
    return list(found), list(words)


def windows(text: str | None) -> list[str]:
    """Distinct windows of a whole text without disguise: sentences and lines, long ones in overlapping pieces.

    A piece has WINDOW_WORDS words; a CJK sign counts as a word. Windows of fewer than two words are left out; see
    word_windows.
    """
    return _pieces(text)[0]


def word_windows(text: str | None) -> list[str]:
    """Distinct windows of the single words that `windows` leaves out or holds whole; they are scored and don't train.

    The word of a sentence or line that has no other, and overlapping pieces of WORD_CHARS signs of every longer word,
    such as a text without blanks.
    """
    return _pieces(text)[1]


class _Coder:
    """Lengths of windows compressed under one dictionary."""

    def __init__(self, content: bytes) -> None:
        d = zstandard.ZstdCompressionDict(content)
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, dict_size=len(content), format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_dict_id=0)
        d.precompute_compress(compression_params=params)
        self.coder = zstandard.ZstdCompressor(dict_data=d, compression_params=params)

    def length(self, data: bytes) -> int:
        return len(self.coder.compress(data))


def train_dictionary(counts: Counter) -> bytes:
    """A dictionary that zstandard trains on windows, each as often as it occurs (up to REPEATS), and what it left out.

    The trained part has the size of the distinct windows, at most half of DICTIONARY_BYTES. Training goes by frequency
    and may leave out a kind of sentence; windows that the dictionary so far compresses to more than KNOWN of their bytes
    are therefore added behind it, the most frequent first, up to the other half. Of too little text (a few windows)
    zstandard makes no dictionary; the added windows are all there is then.
    """
    ordered = [(w.encode("utf-8", "replace"), n) for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    size = max(256, min(DICTIONARY_BYTES // 2, sum(len(w) for w, _ in ordered)))
    samples = [w for w, n in ordered for _ in range(min(n, REPEATS))]
    segment = min(SEGMENT_MOST, max(SEGMENT_LEAST, size // SEGMENTS))
    try:
        trained = zstandard.train_dictionary(size, samples, k=segment, d=PIECE, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        trained = b""
    added: list[bytes] = []
    at, step, room = 0, 32, DICTIONARY_BYTES // 2
    while at < len(ordered) and room > 0:
        some = [w for w, _ in ordered[at : at + step]]
        if trained or added:
            coder = _Coder(trained + _join(added))
            some = [w for w in some if coder.length(w) > KNOWN * len(w) + 4]
        for w in some:
            room -= len(w) + 1
            if room >= 0:
                added.append(w)
        at, step = at + step, min(2 * step, 1024)
    return trained + _join(added) or b"\n" * 8


def _join(windows: list[bytes]) -> bytes:
    return b"\n".join([*reversed(windows), b""]) if windows else b""


@dataclass(frozen=True)
class Model:
    """Dictionaries, the threshold by the labelled documents alone, and the share of marked ones found at each of GRID."""

    ordinary: bytes
    marked: bytes
    threshold: float
    found: tuple[float, ...] = ()

    def __hash__(self) -> int:
        return hash((xxhash.xxh64_intdigest(self.ordinary), xxhash.xxh64_intdigest(self.marked)))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.ordinary, self.marked = _Coder(model.ordinary), _Coder(model.marked)
        self.seen: dict[str, float] = {}

    def window(self, window: str) -> float:
        got = self.seen.get(window)
        if got is None:
            if len(self.seen) > 100_000:
                self.seen.clear()
            data = window.encode("utf-8", "replace")
            a, b = self.ordinary.length(data), self.marked.length(data)
            # A few bytes of frame and headers are the same for both.
            got = self.seen[window] = (a - b) / max(a - 4, SHORT)
        return got

    def document(self, text: str | None) -> float:
        """The score of the worst window; 0 for a text without windows, such as a null or an empty one."""
        found, words = _pieces(text)
        return max(map(self.window, [*found, *words]), default=0.0)


def _model(ordinary: Counter, marked: Counter) -> Scorer:
    return Scorer(Model(train_dictionary(ordinary), train_dictionary(marked), 0.0))


def _seeds(text: str) -> Counter:
    return Counter({plain(line): 1 for line in text.strip().split("\n")})


def _grams(window: str) -> set[str]:
    words = _WORD.findall(window)
    return {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}


def vote(window: str, own: bool, with_mark: Counter, without: Counter, rate: float) -> float | None:
    """Share of marked documents among those with the window's word triples, its own document left out.

    The mean over the half of the triples with the largest shares, since an abusive sentence has plain parts too. Each
    triple starts from PRIOR documents at the overall rate. None if fewer than a third of the triples occur in any other
    document.
    """
    grams = _grams(window)
    shares = []
    for g in grams:
        p, n = with_mark[g] - own, without[g] - (not own)
        if p + n > 0:
            shares.append((p + PRIOR * rate) / (p + n + PRIOR))
    if 3 * len(shares) < len(grams):
        return None
    top = sorted(shares)[len(shares) // 2 :]
    return sum(top) / len(top)


def train(documents: list[tuple[int, str | None, bool]]) -> Model:
    """Dictionaries and threshold from labelled documents (id, text, marked)."""
    cut = [(xxhash.xxh64_intdigest(str(i), SEED) % 2, windows(t), y) for i, t, y in sorted(documents, key=lambda d: d[0])]
    with_mark, without = (Counter(g for _, ws, y in cut if y == kind for g in set().union(*map(_grams, ws))) for kind in (True, False))
    rate = (1 + sum(y for _, _, y in cut)) / (2 + len(cut))
    both = (0, 1)
    bad, good = _seeds(SEED_MARKED), _seeds(SEED_ORDINARY)
    rated = [(h, w, y, vote(w, y, with_mark, without, rate)) for h, ws, y in cut for w in ws]
    # What may train as marked, and what the votes find suspect in unmarked documents.
    maybe = [(h, w, y) for h, w, y, share in rated if (y if share is None else share > (MAYBE if y else SUSPECT))]
    sure = {h: good + Counter(w for g, w, y, share in rated if g == h and (not y if share is None else share <= (rate if y else SUSPECT))) for h in both}
    marked = {h: bad + Counter(w for g, w, y in maybe if g == h and y) for h in both}
    ordinary = sure
    # The dictionaries of the other half decide on these, twice, as the first decision cleans what the second rests on.
    for _ in range(2):
        judge = {h: _model(ordinary[1 - h], marked[1 - h]) for h in both}
        scores = [(h, w, y, judge[h].window(w)) for h, w, y in maybe]
        marked = {h: bad + Counter(w for g, w, y, score in scores if g == h and y and score > MINED) for h in both}
        ordinary = {h: sure[h] + Counter(w for g, w, y, score in scores if g == h and score <= (0 if y else MISSED)) for h in both}
    held_out = {h: _model(ordinary[1 - h], marked[1 - h]) for h in both}
    scored = [(max(map(held_out[h].window, ws), default=0.0), y) for h, ws, y in cut]
    hits = [s for s, y in scored if y]
    found = tuple(sum(s >= t for s in hits) / len(hits) if hits else 0.0 for t in GRID)
    return Model(train_dictionary(ordinary[0] + ordinary[1]), train_dictionary(marked[0] + marked[1]), best_threshold(scored), found)


def calibrate(found: tuple[float, ...], flagged: list[float]) -> float:
    """The threshold of GRID with the best F1 among all documents; the last one without marked documents.

    found: share of marked documents at or above each threshold, held out; flagged: that of all documents. The share of
    abusive documents is at most flagged / found at any threshold, and near it where few others are flagged: its least
    value over the thresholds that find TELLING of the marked ones estimates it. F1 follows from the three shares.
    """
    telling = [f / r for r, f in zip(found, flagged, strict=True) if r >= TELLING]
    if not telling:
        return GRID[-1]
    share = min(telling)
    f1 = [2 * share * r / (share + f) if share + f else 0.0 for r, f in zip(found, flagged, strict=True)]
    return GRID[max(range(len(GRID)), key=lambda i: (f1[i], i))]


def best_threshold(scored: list[tuple[float, bool]]) -> float:
    """The threshold of the best F1 on labelled documents; the middle of the best ones where several are as good."""
    grid, most = list(GRID), GRID[-1]
    positives = sum(y for _, y in scored)

    def f1(t: float) -> float:
        hits = [y for s, y in scored if s >= t]
        return 2 * sum(hits) / max(1, len(hits) + positives)

    if not positives:
        return most
    values = [f1(t) for t in grid]
    top = max(values)
    good = [t for t, v in zip(grid, values, strict=True) if v >= top - 0.002]
    return sorted(good)[len(good) // 2]


@lru_cache(maxsize=4)
def _scorer(model: Model) -> Scorer:
    return Scorer(model)


def score(text: Column, model: Model) -> Column:
    """Score of a text (double); 0 for null and empty ones."""

    def run(texts: pa.Array) -> pa.Array:
        scorer = _scorer(model)
        return pa.array([scorer.document(t.as_py()) for t in texts], pa.float64())

    return F.arrow_udf(run, DoubleType())(text)


def labelled_sample(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED, chars: int = MAX_CHARS) -> list[tuple[int, str | None, bool]]:
    """(id, text, marked) of at most `most` labelled documents with at most `chars` characters in all, the first by a hash of their id.

    A document's raters vote; ties and documents without a vote are left out. Texts are taken whole or not at all: one
    that no longer fits is passed over, and the next ones are tried.
    """
    votes = labels.filter("toxic is not null").groupBy("doc_id").agg(F.avg((F.col("toxic") > 0).cast("int")).alias("share")).filter("share <> 0.5")
    sample = votes.orderBy(F.xxhash64(F.lit(SEED), F.col("doc_id")), "doc_id").limit(most)
    lengths = documents.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("n"), "text").join(F.broadcast(sample), "doc_id")
    # At most `most` ids and lengths come to the driver, then the texts that were taken.
    order = lengths.groupBy("doc_id").agg(F.min("n").alias("n")).orderBy(F.xxhash64(F.lit(SEED), F.col("doc_id")), "doc_id").collect()
    taken, used = [], 0
    for r in order:
        if used + r["n"] <= chars:
            taken.append((r["doc_id"],))
            used += r["n"]
    ids = documents.sparkSession.createDataFrame(taken, documents.select("doc_id").schema)
    few = lengths.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "share").agg(F.min_by("text", F.struct("n", "text")).alias("text"))
    return [(r["doc_id"], r["text"], r["share"] > 0.5) for r in few.orderBy(F.xxhash64(F.lit(SEED), F.col("doc_id")), "doc_id").collect()]


def with_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """documents without their text, with `score` and `flagged`; trained on the labelled sample of the same documents.

    Scores are written once, as the threshold is set on all of them. Without any marked document the seeds alone train,
    and the threshold is the last of GRID. Null and empty texts score 0.
    """
    model = train(labelled_sample(documents, labels))
    scored = materialise(spread(documents).withColumn("score", score(F.col("text"), model)).drop("text"))
    shares = scored.agg(*[(F.count_if(F.col("score") >= t) / F.greatest(F.count(F.lit(1)), F.lit(1))).alias(f"t{i}") for i, t in enumerate(GRID)]).first()
    return scored.withColumn("flagged", F.col("score") >= calibrate(model.found, list(shares)))
