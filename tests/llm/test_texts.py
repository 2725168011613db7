"""Quality, languages, licenses and fingerprints."""

import hashlib
import random
import re

import numpy as np
import pytest
from cases import AWKWARD, documents, words

from driftwell.llm import language, licenses, minhash, quality


# Quality


def test_quality_on_the_given_labels(spark, tables_dir):
    docs, labels = spark.read.parquet(f"{tables_dir}/documents.parquet"), spark.read.parquet(f"{tables_dir}/labels.parquet")
    found = quality.quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    assert found["score"].between(0, 1).all()
    assert ((found["score"] >= 0.3) == (found["predicted"] == 1)).all()
    assert (found["predicted"] == found["quality"]).mean() > 0.9


def test_quality_never_learns_from_the_held_out_fifth(spark, tables_dir):
    docs, labels = spark.read.parquet(f"{tables_dir}/documents.parquet"), spark.read.parquet(f"{tables_dir}/labels.parquet")
    wrong = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - quality, quality) AS quality", "toxic")
    one, two = (quality.quality_scores(docs, x).orderBy("doc_id").toPandas() for x in (labels, wrong))
    assert np.allclose(one["score"], two["score"])


def test_quality_of_awkward_rows(spark):
    docs = documents(spark, AWKWARD, [None, *range(1, len(AWKWARD))])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int, score int")
    assert {r["score"] for r in quality.quality_scores(docs, none).collect()} == {0.5}
    labels = spark.createDataFrame([(i, i % 2) for i in range(9)] + [(1, None), (2, 0), (None, 1)], "doc_id long, quality int")
    found = quality.quality_scores(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == len(AWKWARD)
    assert all(0 <= r["score"] <= 1 for r in found.collect())
    assert quality.quality_scores(documents(spark, []), labels).count() == 0


def test_isotonic_levels_are_monotone_and_means():
    x = np.arange(6.0)
    knots, levels = quality.isotonic(x, np.array([0, 1, 0, 1, 1, 0.0]), np.ones(6))
    assert (np.diff(levels) > 0).all() and (np.diff(knots) > 0).all()
    assert levels.tolist() == [0, 0.5, 2 / 3]


def test_normal_equations_are_those_of_one_matrix(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(200, quality.WIDTH)), rng.integers(0, 2, 200).astype(float)
    frame = spark.createDataFrame([(a.tolist(), float(b), i % 4) for i, (a, b) in enumerate(zip(x, y))], "x array<double>, y double, fold int")
    kernel = quality.Kernel.draw(x.mean(axis=0), x.std(axis=0), 20, 3)
    sums = quality._normal_equations(frame.repartition(5), kernel, 4).sum(axis=0)
    z = kernel.map(x)
    assert np.allclose(sums[:, :-1], z.T @ z) and np.allclose(sums[:, -1], z.T @ y)


# Languages


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(1)
    parts = {"aa": ["ka", "lo", "mi", "ra"], "bb": ["sch", "ung", "ver", "ich"], "cc": ["eau", "oui", "tre", "lle"]}
    text = {k: lambda n, v=v: " ".join("".join(rng.choices(v, k=3)) for _ in range(n)) for k, v in parts.items()}
    rows = [(k, text[k](rng.randrange(5, 60))) for k in parts for _ in range(60)]
    return documents(spark, [t for _, t in rows], langs=[k for k, _ in rows]), text


def test_languages_and_mixtures(spark, tongues):
    docs, text = tongues
    found = language.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["lang"] == r["lang_pred"] and 0 < r["score"] <= 1 for r in found)
    model = language.learn_from(docs)
    shares = model.proportions(f"{text['aa'](70)} {text['bb'](30)}")
    assert list(shares) == ["aa", "bb"] and 0.5 < shares["aa"] < 0.85
    assert list(model.proportions(text["cc"](40))) == ["cc"]


def test_languages_of_awkward_rows(spark, tongues):
    docs, _ = tongues
    model = language.learn_from(docs)
    odd = documents(spark, [*AWKWARD, "123 !?", "é"], [None, *range(1, len(AWKWARD) + 2)])
    found = {r["text"]: r["found"] for r in odd.select("text", language.detect_column(model, odd["text"]).alias("found")).collect()}
    unknown = {t for t, f in found.items() if f["lang_pred"] == "und"}
    assert unknown == {None, "", " \n\t ", "123 !?"}
    assert all(f["score"] == 0 for t, f in found.items() if t in unknown)
    assert {r["lang_pred"] for r in language.identify_languages(documents(spark, ["some text"], langs=[None])).collect()} == {"und"}
    assert language.identify_languages(documents(spark, [])).count() == 0


def test_languages_never_learn_from_the_held_out_fifth(spark, tongues):
    docs, _ = tongues
    wrong = docs.selectExpr("doc_id", "text", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 'zz', lang) AS lang")
    one, two = (sorted(map(tuple, language.identify_languages(d).collect())) for d in (docs, wrong))
    assert one == two


def test_em_reaches_the_best_proportions(tongues):
    docs, text = tongues
    model = language.learn_from(docs)
    mixed = f"{text['aa'](50)} {text['cc'](50)}"
    cells, counts = np.unique(language.trigram_cells(mixed), return_counts=True)
    likelihood = lambda p: counts @ np.log(p * np.exp(model.logs[cells, 0]) + (1 - p) * np.exp(model.logs[cells, 2]))
    best = max(np.linspace(0.01, 0.99, 99), key=likelihood)
    assert abs(model.proportions(mixed)["aa"] - best) < 0.02


# Licenses


def brute_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = [(i, n.label) for n in licenses.BASE_NOTICES for i in range(len(w)) if w[i : i + len(n.words.split())] == n.words.split()]
    places = [i for i, _ in found]
    return len(w), len(found), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in found}))


def test_base_phrases_agree_with_brute_force(spark):
    rng = random.Random(3)
    phrases = ["under the MIT License", "Apache License, Version 2.0", "CC BY-NC 4.0", "under-the-mit_license", "Apache License 2", "dÉ cc by nc"]
    texts = [rng.choice([" ", "\n", ". "]).join(rng.choice([rng.choice(phrases), *words(rng, 3)]) for _ in range(rng.randrange(1, 40))) for _ in range(80)]
    texts += [*AWKWARD, "cc by nc " * 3000]
    found = licenses.license_scan(documents(spark, texts)).orderBy("doc_id").collect()
    got = [(r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found]
    assert got == [brute_base(t) for t in texts]
    assert all(set(r["base_labels"].split(",")) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in found if r["base_labels"])
    assert licenses.license_scan(documents(spark, [])).count() == 0


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    out = [i + 1]
    for j, y in enumerate(b):
        out.append(min(row[j] + (x != y), row[j + 1] + 1, out[-1] + 1))
    return out


def test_errors_within_the_bound_are_found_with_their_span():
    rng = random.Random(8)
    for notice in licenses.FUZZY_NOTICES:
        for _ in range(25):
            changed = list(notice.words)
            for _ in range(notice.edits):
                at = rng.randrange(1, len(changed) - 1)
                rng.choice([lambda: changed.__setitem__(at, "q"), lambda: changed.pop(at), lambda: changed.insert(at, "q")])()
            line = f" {' '.join(words(rng, 8))} {''.join(changed)} {' '.join(words(rng, 8))} ".encode()
            spans = licenses.fuzzy_spans(line, notice)
            assert spans
            for a, b, edits in spans:
                assert edits <= notice.edits
                assert edit_distance(line[a:b].decode(), notice.words) <= edits
    assert licenses.scan_text("the quick brown fox under the table", licenses.BASE_NOTICES, licenses.FUZZY_NOTICES)[5] == ""


@pytest.mark.parametrize(
    ("text", "labels", "score"),
    [
        ("Released under the BSD license.", "", 0.0),
        ("licensed under CC BY-SA 4.0", "", 0.0),
        ("licensed under CC BY-ND 4.0", "", 0.0),
        ("Licensed under the GNU General Public License, version 2.", "gpl-2", 1.0),
        ("Licensed under the GNU General Public License, version 3", "gpl-3", 1.0),
        ("Licensed under the Mozilla Public License, version 1.1", "", 0.0),
        ("Licensed under the Mozilla Public License, version 2.0", "mpl-2", 1.0),
        ("Licensed under the Apache License, version 1.1", "", 0.0),
        ("released under the permit license", "", 0.0),
        ("relesed undr the MIT license", "mit", 1 - 2 / 30),
        ("licenced under the GNU General Publc License version 3 and more", "gpl-3", 1 - 2 / 55),
        ("some words licensd under CC BY-NC 4.0 here", "cc-by-nc", 1.0),
    ],
)
def test_notices_of_other_licenses_are_told_apart(text, labels, score):
    found = licenses.scan_text(text, licenses.BASE_NOTICES, licenses.FUZZY_NOTICES)
    assert (found[5], found[6]) == (labels, pytest.approx(score))


def test_edited_notices_before_and_behind_a_better_one():
    notice, exact = licenses.FUZZY_NOTICES[0], "released under the mit license"
    for told in (False, True):
        line = f" released under teh mit license {exact} relesed under the mit license ".encode()
        assert [edits for *_, edits in licenses.fuzzy_spans(line, notice, told)] == [2, 0, 1]
    assert len(licenses.fuzzy_spans(f" {exact}".encode() * 3000 + b" ", notice, True)) == 3000


def test_edits_beside_the_telling_word_are_all_found():
    rng = random.Random(8)
    for notice in [n for n in licenses.FUZZY_NOTICES if n.telling]:
        before, telling, after = f" {notice.words} ".partition(f" {notice.telling} ")
        for _ in range(25):
            parts = [list(before.strip()), list(after.strip())]
            for _ in range(notice.edits):
                part = rng.choice([p for p in parts if len(p) > 4])
                at = rng.randrange(1, len(part) - 1)
                rng.choice([lambda: part.__setitem__(at, "q"), lambda: part.pop(at), lambda: part.insert(at, "q")])()
            changed = " ".join(["".join(parts[0]), notice.telling, "".join(parts[1])]).strip()
            line = f" {' '.join(words(rng, 8))} {changed} {' '.join(words(rng, 8))} ".encode()
            spans = licenses.fuzzy_spans(line, notice, told=True)
            assert spans and all(edits <= notice.edits and edit_distance(line[a:b].decode(), notice.words) <= edits for a, b, edits in spans)


# Fingerprints


def jaccard(a, b):
    sets = []
    for t in (a, b):
        w = (t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def test_edited_neighbours(spark):
    rng = random.Random(12)
    texts = [" ".join(words(rng, rng.choice([1, 3, 30, 200, 900]), 5000)) for _ in range(120)]
    for i in range(0, 60, 2):
        w = texts[i].split()
        texts[i + 1] = " ".join(w[: max(1, len(w) * rng.randrange(1, 10) // 10)])
    texts = [t for t in texts] + ["ASCII only " * 30, "", "", "ünï cödé 🙂 text", "x"]
    ids = rng.sample(range(10_000), len(texts))
    found = {r["doc_id"]: r for r in minhash.edited_neighbours(documents(spark, texts, ids).repartition(6)).collect()}
    order = sorted(zip(ids, texts))
    errors = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert (found[i]["n_chars"], found[i]["edited"]) == (len(t), edited)
        errors += [found[i]["near_edited"] - jaccard(t, edited), found[i]["near_next"] - jaccard(t, after)]
    assert abs(np.mean(errors)) < 0.01 and np.max(np.abs(errors)) < 0.16
    by_text = {}
    for i, t in order:
        by_text.setdefault(t, set()).add(found[i]["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values()) and by_text[""] == {""}


def test_fingerprints_of_awkward_rows(spark):
    docs = documents(spark, [*AWKWARD, AWKWARD[5]], [None, *range(len(AWKWARD))])
    rows = minhash.fingerprints(docs).collect()
    assert len(rows) == len(AWKWARD) + 1
    assert {len(r["fingerprint"]) for r in rows} == {0, 2 * minhash.BINS}
    assert all(r["packed"].hex() == r["fingerprint"] for r in rows)
    assert minhash.edited_neighbours(documents(spark, [])).count() == 0
    one = minhash.edited_neighbours(documents(spark, ["abcd"])).first()
    assert (one["edited"], one["near_next"]) == ("abab", 1.0)
    same = minhash.edited_neighbours(documents(spark, ["b b b b b b", "a a a a a a", None], [1, 1, None])).collect()
    # By id, then text: null, "a ...", "b ..."; each ends like the next.
    assert sorted(r["edited"] for r in same) == ["", "a a a b b b", "b b b "]


def test_fingerprints_stay_in_the_jvm(spark, tables_dir):
    frame = minhash.edited_neighbours(spark.read.parquet(f"{tables_dir}/documents.parquet"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert "SinglePartition" not in plan


def test_sha_of_edited_text(spark):
    row = minhash.edited_neighbours(documents(spark, ["é1", "z"])).selectExpr("doc_id", "sha2(edited, 256) AS h").orderBy("doc_id").first()
    assert row["h"] == hashlib.sha256("éz".encode()).hexdigest()


def test_many_edited_notices_take_time_in_proportion(spark):
    """A text that is nothing but notices with one edit each; a megabyte of them takes seconds."""
    import time

    rng = random.Random(9)

    def text(n):
        out = []
        for _ in range(n):
            at = rng.randrange(3, 8)
            out.append("released under the mit license"[:at] + rng.choice("xyz") + "released under the mit license"[at + 1 :])
        return " ".join(out)

    def seconds(n):
        given, began = text(n), time.process_time()
        found = licenses.scan_text(given, licenses.BASE_NOTICES, licenses.FUZZY_NOTICES)
        assert [x.rpartition(":")[2] for x in found[7]] == ["1"] * n
        return time.process_time() - began

    seconds(200)
    short, long = seconds(2_000), seconds(32_000)
    assert long < 30 * short and long < 60
