import random

import pytest

from corundum.llm import toxicity


@pytest.mark.parametrize(
    ("disguised", "shown"),
    [("You are an 1diot", "you are an idiot"), ("what a t.r.o.l.l", "what a troll"), ("m o r o n !", "moron !"), ("ѕtuріd", "stupid"), ("fooool", "fol"), ("ZINC000012", "zinc0"), ("it costs 12,5", "it costs 0"), ("bas​alt", "basalt"), ("Énergie", "energie")],
)
def test_disguises_are_read_through(disguised, shown):
    assert toxicity.plain(disguised) == shown


def test_windows_cover_whole_texts():
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(200)]
    text = " ".join(words)
    assert {w for x in toxicity.windows(text) for w in x.split(" ")} == set(words)
    assert toxicity.windows(None) == toxicity.windows("") == toxicity.windows(" \n ") == []
    assert toxicity.windows("One here. Two there! Three\nfour lines. 第一句话。第二句话。") == ["one here.", "two there!", "four lines.", "第一句话。", "第二句话。"]
    assert toxicity.windows("Same one. Same one.") == ["same one."]


HARMLESS = ["the {} file was merged with the {} table", "has anyone checked the {} for the {} run?", "i hate this {}, it is crap and the {} is worthless", "please rerun the {} before the {} stage"]
ABUSIVE = ["you are a stupid {} and everybody in the {} hates you", "get lost, you worthless {}, and take your {} with you", "people like that {} are vermin and ruin the {}"]
THINGS = ["splitter", "batch", "energy", "charge", "filter", "atom", "bond", "frame", "queue", "report"]


def corpus(rng, n, noise):
    say = lambda kinds: rng.choice(kinds).format(rng.choice(THINGS), rng.choice(THINGS))
    out = []
    for i in range(n):
        bad = rng.random() < 0.3
        parts = [say(HARMLESS) for _ in range(rng.randrange(2, 7))]
        if bad:
            parts.insert(rng.randrange(len(parts) + 1), say(ABUSIVE))
        out.append((i, ". ".join(parts), bad, bad != (rng.random() < noise)))
    return out


def test_held_out_accuracy_with_noisy_labels():
    rng = random.Random(4)
    model = toxicity.train([(i, t, label) for i, t, _, label in corpus(rng, 300, 0.06)])
    scorer = toxicity.Scorer(model)
    fresh = corpus(rng, 300, 0)
    hits = [(scorer.document(t) >= model.threshold, bad) for _, t, bad, _ in fresh]
    right = sum(a and b for a, b in hits)
    assert right / sum(b for _, b in hits) > 0.9 and right / max(1, sum(a for a, _ in hits)) > 0.9


def test_without_labels_the_seeds_train():
    model = toxicity.train([])
    scorer = toxicity.Scorer(model)
    assert scorer.document("Shut up, you worthless piece of shit.") >= model.threshold > scorer.document("This script is crap, the damn build broke.")
    assert scorer.document(None) == scorer.document("") == 0.0


def test_columns(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "Shut up, you worthless piece of shit.", "a"), (4, "word " * 50_000, "b"), (5, "Fine.", None), (5, "Fine.", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(5, "r", 0), (5, "s", None), (4, "r", 1), (4, "s", 0)], "doc_id bigint, rater string, toxic int")
    got = toxicity.with_scores(docs, labels)
    assert got.count() == 6 and {r["doc_id"] for r in got.filter("flagged").collect()} == {3}
    assert toxicity.labelled_sample(docs, labels) == [(5, "Fine.", False)]
    assert toxicity.with_scores(docs.limit(0), labels.limit(0)).count() == 0


def test_single_words_and_dotted_words_are_scored():
    assert toxicity.word_windows("Asshole!\nTwo words. Fine.") == ["asshole!", "fine."]
    long = "".join(chr(97 + i * i % 26) + str(i % 10) for i in range(500))
    pieces = toxicity.word_windows(f"see {long} here")
    assert max(map(len, pieces)) <= toxicity.WORD_CHARS and {p[:9] for p in pieces} >= {toxicity.plain(long)[:9]} and pieces[-1][-9:] == toxicity.plain(long)[-9:]
    assert toxicity.windows("go k.i.l.l. .y.o.u.r.s.e.l.f.") == ["go kill yourself."]
    assert toxicity.windows("what a t.r.o.l.l. Next one.") == ["what a troll.", "next one."]
    assert toxicity.word_windows(None) == toxicity.word_windows("") == toxicity.word_windows(" \n ") == []
    scorer = toxicity.Scorer(toxicity.train([]))
    assert scorer.document("you-stupid-idiot-everybody-hates-you") > 0 and scorer.document("go.kill.yourself.you.worthless.piece.of.shit" + "x" * 3000) > 0


def test_one_long_document_leaves_room_for_the_others(spark):
    rows = [(i, "x" * 40) for i in range(20)] + [(100 + i, "y" * 5000) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, "r", int(i % 2)) for i, _ in rows], "doc_id bigint, rater string, toxic int")
    got = toxicity.labelled_sample(docs, labels, chars=1000)
    assert sorted(i for i, _, _ in got) == list(range(20)) and sum(len(t) for _, t, _ in got) <= 1000
    assert len(toxicity.labelled_sample(docs, labels, most=5)) == 5 and toxicity.labelled_sample(docs.limit(0), labels) == []


def test_threshold_follows_the_share_of_all_documents():
    # Of the marked ones all score up to 0.5; of all documents 4 % do, and below 0.2 many harmless ones as well.
    found = tuple(1.0 if t <= 0.5 else 0.0 for t in toxicity.GRID)
    flagged = [0.04 + (0.3 if t < 0.2 else 0.0) if t <= 0.5 else 0.0 for t in toxicity.GRID]
    assert 0.2 <= toxicity.calibrate(found, flagged) <= 0.5
    assert toxicity.calibrate(tuple(0.0 for _ in toxicity.GRID), flagged) == toxicity.GRID[-1]
    assert toxicity.calibrate(found, [0.0] * len(found)) in toxicity.GRID


def test_a_dictionary_is_trained_at_every_size():
    for n in (40, 400):
        made = toxicity.train_dictionary(toxicity.Counter({f"{w} the {t} of the {u}": 2 for w in ("merge", "check", "open") for t in toxicity._seeds(toxicity.SEED_ORDINARY) for u in map(str, range(n // 40))}))
        assert made[:4] == b"\x37\xa4\x30\xec" and len(made) <= toxicity.DICTIONARY_BYTES + 1024
    assert toxicity.train_dictionary(toxicity.Counter()) and toxicity.train_dictionary(toxicity.Counter(["one"]))
