"""Registration, SQL twins, and the pipeline against a plain version of itself."""

import os
import random
import re
import shutil
import subprocess
import sys

import oracle
import pytest
from cases import words
from pyspark.sql import functions as F
from test_contamination import brute as brute_leaks
from test_simhash import direct

import corpus_pipeline
from driftwell.llm import queries
from driftwell.llm.queries import tokenizer_path

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, tables_dir, name):
    connection = oracle.connect(tables_dir)
    frame = queries.QUERIES[name](spark, tables_dir)
    oracle.compare(frame, connection, queries.ORACLES[name])
    assert oracle.integer_widths(frame, connection, queries.ORACLES[name]) == {}


def test_every_operator_is_a_query_with_the_agreed_columns(spark, tables_dir):
    import __spark_entry__ as driver

    wanted = {
        1: "doc_id held_out score predicted",
        2: "doc_id fingerprint component_id",
        3: "doc_id n_words n_base first_word last_word base_labels labels score",
        4: "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
        5: "doc_id held_out lang_pred score",
        6: "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
        7: "doc_id start length ids_crc32 doc_tokens sequence_id offset",
        8: "doc_id item_id",
        9: "doc_id n_bytes n_removed n_spans kept_sha256",
        10: "doc_id n_words n_removed kept_sha256",
        11: "query_id rank vec_id score",
        12: "doc_id leaf subroot root proof_sha256 folded_root verified",
        13: "vec_id component n deviation whitened explained identity_error",
    }
    every = driver.queries()
    assert "pipeline" in every
    documents = spark.read.parquet(f"{tables_dir}/documents.parquet").count()
    for number, columns in wanted.items():
        (name,) = [q for q in every if q.startswith(f"op{number}_")]
        frame = every[name](spark, tables_dir)
        assert set(columns.split()) <= set(frame.columns), name
        if number not in (6, 7, 8, 11, 13):
            assert frame.count() == documents


def plain_pipeline(rows, items):
    """The documents that reach packing and their texts."""
    rows = [r for r in rows if r[1] is not None and re.search(r"[^\W\d_]", r[1])]
    prints = [direct(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group):
        least[g] = min(least.get(g, i), i)
    rows = [r for r, g in zip(rows, group) if r[0] == least[g]]
    seen = {}
    for _, t in rows:
        w = t.split()
        for s in range(len(w) - 34):
            seen[tuple(w[s : s + 35])] = seen.get(tuple(w[s : s + 35]), 0) + 1
    cleaned = []
    for i, t in rows:
        w, gone = t.split(), set()
        for s in range(len(w) - 34):
            if seen[tuple(w[s : s + 35])] > 1:
                gone.update(range(s, s + 35))
        cleaned.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t))
    leaked = {cleaned[d][0] for d, _ in brute_leaks([t for _, t in cleaned], items)}
    return {i: t for i, t in cleaned if i not in leaked}


@pytest.fixture
def planted(spark, tmp_path):
    rng = random.Random(11)
    fresh = lambda n: [f"v{x}z" for x in rng.sample(range(50_000), n)]
    items = [(i, " ".join(fresh(rng.randrange(8, 25)))) for i in range(8)]
    texts = [" ".join(fresh(rng.randrange(20, 150))) for _ in range(80)]
    passage = fresh(50)
    texts += [" ".join([*fresh(30), *passage, *fresh(30)]) for _ in range(6)]
    texts += [" ".join([*fresh(30), *rng.choice(items)[1].split(), *fresh(30)]) for _ in range(10)]
    texts += [texts[3], texts[3], texts[4] + "!", None, "", "123 456", "x", "x", "Y"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    frame = spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), sorted(rows), items


def test_pipeline_agrees_with_a_plain_version(spark, planted):
    from tokenizers import Tokenizer

    directory, rows, items = planted
    expected = plain_pipeline(rows, items)
    tokens = Tokenizer.from_file(tokenizer_path())
    pieces = corpus_pipeline.run(spark, directory).collect()
    assert {p["doc_id"]: p["doc_tokens"] for p in pieces} == {
        i: len(tokens.encode(t, add_special_tokens=False).ids) + 1 for i, t in expected.items()
    }
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    schema = docs.schema
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, directory)
        assert docs.schema.fieldNames() == schema.fieldNames()
    assert {r["doc_id"]: r["text"] for r in docs.collect()} == expected


def test_stages_take_empty_tables_and_rows_without_ids(spark, planted):
    directory, _, _ = planted
    docs = spark.read.parquet(f"{directory}/documents.parquet").withColumnRenamed("source", "fingerprint")
    for frame, count in ((docs.where("doc_id < 0"), 0), (docs.where("doc_id < 3").selectExpr("CAST(NULL AS BIGINT) AS doc_id", "* EXCEPT (doc_id)"), 3)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, directory).count() == count
        assert corpus_pipeline.STAGES[-1][1](spark, frame, directory).count() >= count


CLASHING = ("row", "doc", "found", "order", "mark", "spans", "rest", "given", "kept", "place", "component_id", "__row", "__doc", "__language")


def test_columns_of_any_name_come_through(spark, planted):
    """Names that the stages use themselves, and one that needs quoting."""
    directory, rows, _ = planted
    docs = spark.read.parquet(f"{directory}/documents.parquet")
    named = {c: F.concat(F.lit(c), F.col("doc_id")) for c in CLASHING}
    docs = docs.withColumns(named).withColumn("a b", F.struct(F.col("doc_id").alias("text")))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, directory)
    assert docs.columns[-1] == "a b" and docs.count() > 50
    assert docs.where(" OR ".join(f"`{c}` <> concat('{c}', doc_id)" for c in CLASHING)).count() == 0
    assert docs.where("`a b`.text <> doc_id").count() == 0


def test_the_language_model_decides(spark, planted):
    directory, _, _ = planted
    rng = random.Random(4)
    tongues = {"aa": "abcdef", "zz": "uvwxyz"}

    def text(tongue, n):
        return " ".join("".join(rng.choices(tongues[tongue], k=5)) for _ in range(n))

    rows = [(i, text(t, 60), t) for i, t in enumerate(["aa", "zz"] * 30)]
    mixed = f"{text('aa', 40)} {text('zz', 60)}"
    rows += [(100, text("aa", 60), None), (101, text("zz", 60), None), (102, mixed, None), (103, "1 2 3", "aa"), (104, None, "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")

    def kept(**options):
        return {r["doc_id"]: r["lang"] for r in corpus_pipeline.language_id(spark, docs, directory, **options).collect()}

    assert kept() == {i: t for i, _, t in rows[:60]} | {100: "aa", 101: "zz", 102: "zz"}
    assert set(kept(least_share=0.8)) == {*range(60), 100, 101}
    assert kept(languages=["zz"]) == {i: "zz" for i in range(1, 60, 2)} | {101: "zz", 102: "zz"}


def test_rows_that_share_an_id_leave_one(spark, planted):
    directory, _, _ = planted
    docs = spark.createDataFrame([(1, "same text of two rows"), (1, "same text of two rows"), (2, "another one is here")], "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, directory)
    assert sorted(map(tuple, kept.collect())) == [(1, "same text of two rows"), (2, "another one is here")]


def test_rows_without_or_with_shared_ids_are_filtered_like_others(spark, planted):
    directory, _, items = planted
    quoted = items[0][1]
    rows = [
        (None, "some text that stands here twice"), (None, "some text that stands here twice"), (3, "some text that stands here twice"),
        (None, "a clean text that has no id"), (4, "one of two texts that share their id"), (4, "the other text is of another kind"),
        (None, f"without an id {quoted}"), (5, f"with a shared id {quoted} again"), (5, "nothing from the items in here"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, docs, directory)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(rows[2:], key=str)
    kept = corpus_pipeline.decontamination(spark, kept, directory)
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([*rows[2:6], rows[8]], key=str)


def test_the_rest_works_without_this_package(tmp_path):
    for name in ("driftwell", "tests", "__spark_entry__.py"):
        source = os.path.join(ROOT, name)
        ignore = shutil.ignore_patterns("llm", "__pycache__")
        shutil.copytree(source, tmp_path / name, ignore=ignore) if os.path.isdir(source) else shutil.copy(source, tmp_path)
    code = "import __spark_entry__ as d; q = d.queries(); assert q and 'pipeline' not in q and not any(x.startswith('op1_') for x in q)"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, check=True, timeout=120)
