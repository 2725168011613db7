"""Decontamination: planted passages, re-parameterised ones, and clean texts."""

import random

from cases import AWKWARD, documents, words

from driftwell.llm import contamination

ITEMS = [
    (1, "A train leaves Berlin at 9 and covers 120 km in 2 hours before it meets Anna near the old bridge in Berlin."),
    (2, "The quick brown fox jumps over the lazy dog while a second fox looks on from the hill and says nothing at all."),
    (3, "Five words are just enough"),
    (4, "too short"),
    (None, "An item that has no id can still be met by any document that quotes all of it in full."),
]


def items(spark, rows=ITEMS):
    return spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "item_id long, text string, at int, window string")


def leaks(spark, texts, rows=ITEMS, **options):
    found = contamination.find_contamination(documents(spark, texts), items(spark, rows), **options)
    return {(r["doc_id"], r["item_id"]): r["slots_changed"] for r in found.collect()}


def test_planted_and_changed_passages(spark):
    pad = "some filler words before it starts here"
    texts = [
        f"{pad}. {ITEMS[0][1]} {pad}",
        f"{pad}. {ITEMS[0][1].replace('Berlin', 'Madrid').replace('120 km', '300 km').replace('Anna', 'Peter')} {pad}",
        # The two cities were one: the values do not map one to one.
        f"{pad}. {ITEMS[0][1].replace('Berlin', 'Madrid', 1).replace('at 9', 'at 2').replace('120 km', '2 miles').replace('Anna', 'Peter')} {pad}",
        f"{pad} {ITEMS[1][1].upper()} {pad}",
        f"{pad} {ITEMS[1][1].replace(' ', chr(10))} {pad}",
        f"{pad}. {ITEMS[2][1]} {pad}",
        "too short",
        ITEMS[4][1],
        f"{pad} {' '.join(ITEMS[1][1].split()[:9])} {pad}",
        pad * 5,
    ]
    assert leaks(spark, texts) == {(0, 1): 0, (1, 1): 3, (3, 2): 0, (4, 2): 0, (5, 3): 0, (7, None): 0}


def test_filter_ahead_of_the_join_changes_nothing(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, rng.randrange(5, 30), 200)).capitalize() + ".") for i in range(20)]
    texts = [" ".join([*words(rng, 30, 200), *rng.choice(rows)[1].split()[rng.randrange(3) :], *words(rng, 30, 200)]) for _ in range(60)]
    with_filter = leaks(spark, texts, rows)
    assert with_filter and with_filter == leaks(spark, texts, rows, filter_windows=0)


def brute(texts, rows, window=8, coverage=0.5):
    """Plain lower-case words only: no placeholders."""
    found = set()
    for i, item in rows:
        w = item.split()
        size = min(window, len(w))
        own = [tuple(w[k : k + size]) for k in range(len(w) - size + 1)]
        for d, t in enumerate(texts):
            x = t.split()
            there = {tuple(x[k : k + size]) for k in range(len(x) - size + 1)}
            if len(w) >= 5 and sum(o in there for o in own) >= coverage * len(own):
                found.add((d, i))
    return found


def test_agrees_with_brute_force_on_plain_words(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(f"v{x}z" for x in rng.sample(range(10_000), rng.randrange(3, 40)))) for i in range(30)]
    texts = []
    for _ in range(120):
        w = rng.choice(rows)[1].split()
        a, b = sorted(rng.sample(range(len(w) + 1), 2))
        texts.append(" ".join([*(f"v{x}z" for x in rng.sample(range(10_000), 20)), *w[a:b], "between", *w[b:]]))
    assert set(leaks(spark, texts, rows)) == brute(texts, rows)


def test_awkward_rows(spark):
    texts = [*AWKWARD, ITEMS[1][1] + " " + "long text " * 60_000, (ITEMS[1][1] + " ") * 300]
    assert set(leaks(spark, texts)) == {(len(AWKWARD), 2), (len(AWKWARD) + 1, 2)}
    assert leaks(spark, []) == {} and leaks(spark, texts, []) == {} and leaks(spark, texts, [(9, None), (8, "")]) == {}
    twice = [(2, ITEMS[1][1]), (2, ITEMS[1][1])]
    assert leaks(spark, [ITEMS[1][1]], twice) == {(0, 2): 0}


def test_names_at_sentence_starts_and_in_any_case(spark):
    rows = [
        (1, "Alice has 3 apples. Alice buys 5 more. How many apples does Alice have?"),
        (2, "On Monday the farmer Hans sold apples to Anna in Berlin while Otto and Emma from Hamburg went to Bremen with Karl."),
    ]
    texts = [
        "Bob has 8 apples. Bob buys 9 more. How many apples does Bob have?",
        rows[0][1].lower(),
        rows[1][1].lower(),
        rows[1][1].upper(),
        "Bob has 8 pears. Bob eats 9 more. How few pears are left?",
    ]
    assert leaks(spark, texts, rows) == {(0, 1): 3, (1, 1): 0, (2, 2): 0, (3, 2): 0}


def test_items_of_mostly_placeholders_are_found_unchanged(spark):
    rows = [(1, "What is 12 + 34 * 56 - 78 / 9 ?"), (2, "On 3 May 2019 at 10 Anna paid 45 dollars 6 cents for 7 kg 8 g")]
    texts = [
        f"see here. {rows[0][1]} and so on",
        rows[0][1].replace("56", "57"),
        f"see here. {rows[1][1].lower()} and so on",
        rows[1][1].replace("45", "46").replace("2019", "2020").replace("7 kg", "9 kg"),
    ]
    assert leaks(spark, texts, rows) == {(0, 1): 0, (2, 2): 0}


def test_words_forgotten_between_texts_change_nothing(monkeypatch):
    """Hash and flags of words in bulk, by number; no number may outlive the words it stands for."""
    texts = ["Mr. Smith paid $3.50 for 12 KM of rope!", "rope, Rope and ROPE ...", "a 1st km? (yes.)", ""] * 2
    whole = contamination._Vocabulary(frozenset({contamination._hash("smith")}), frozenset({contamination._hash("rope")}))
    kept = [contamination.Template(t, whole) for t in texts]
    monkeypatch.setattr(contamination, "KEPT_WORDS", 3)
    short = contamination._Vocabulary(whole.names, whole.common)
    for text, one in zip(texts, kept):
        other = contamination.Template(text, short)
        assert one.kinds.tolist() == other.kinds.tolist() and one.hashes.tolist() == other.hashes.tolist()
        assert one.plain.tolist() == [contamination._hash(contamination._EDGES.sub("", one.raw[k]).lower()) for k in one.kept]
    assert len(short) < len(whole)
