"""The pipeline against plain Python over small documents, and the queries against their SQL."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from ledgerloom.llm import jaccard
from ledgerloom.llm.queries import ORACLES, QUERIES
from ledgerloom.paths import children, scratch_root
from tests.llm.test_similarity import linked_by_hand

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
# A column of each of the names that operators add, and one that is of another type.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, matches int, row string, spans string"


def documents(rnd):
    say = lambda n: " ".join("".join(rnd.choices("aeinrst", k=rnd.randint(2, 9))) for _ in range(n))
    base, item = say(60), say(30)
    records = [(i, say(rnd.randint(5, 80))) for i in range(40)]
    records += [(100, base), (101, base), (102, f"{base} more"), (103, f"start {say(40)} {item} {say(20)}")]
    records += [(110, None), (111, ""), (112, "12 !! 34"), (113, "x"), (120, f"{say(9)} a.b@c.org or +1 (212) 555-0100, {say(9)}")]
    records += [(130, f"{say(40)} é"), (130, f"{say(40)} é"), (130, say(50)), (None, say(44))]
    records += records[-3:-2]
    table = [(i, t, "xx" if t and k % 2 else None, "s", len(t or ""), "own", k, "own", None) for k, (i, t) in enumerate(records)]
    return [*table, table[-1]], item


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    table, item = documents(random.Random(11))
    spark.createDataFrame(table, DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, table


def test_run_against_plain_python(spark, small):
    folder, table = small
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    spoken = [r for r in table if any(c.isalpha() for c in r[1] or "")]
    different = sorted(set(spoken), key=lambda r: (r[0] is not None, r[0] or 0))
    groups = linked_by_hand([(k, r[1]) for k, r in enumerate(different)])
    firsts = [r for k, r in enumerate(different) if groups[k][2] == k]
    clean = [r for r in firsts if r[0] != 103]
    texts = [(r[0], r[1].replace("a.b@c.org", "[EMAIL]").replace("+1 (212) 555-0100", "[PHONE]")) for r in clean]
    expected = Counter((i, tuple(library.encode(t, add_bos=True, add_eos=True))) for i, t in texts)
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in found) == expected
    assert all(r.n_tokens == len(r.ids) // 4 for r in found) and len(expected) > 40


def test_stages_keep_the_columns_and_bear_empty_tables(spark, small):
    folder, table = small
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for source in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, source, folder)
            assert kept.dtypes == source.dtypes, name
            source = kept
    assert source.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), folder).count() == 0


@needs_tables
def test_pipeline_is_registered(spark):
    found = queries()["pipeline"](spark, SF_DIR)
    assert found.columns == ["doc_id", "n_tokens", "ids", "ends"]
    assert 100 < found.count() <= 200


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = Counter(tuple(row) for row in df.select(columns).collect())
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]}) q").fetchall()
    assert found == Counter(expected)


@needs_tables
def test_each_operator_has_its_query():
    assert [int(n[2:].split("_")[0]) for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == list(range(1, 14))


def five_word_groups(texts):
    """The first text of each text's group by five-word shingles and a similarity of 0.8, all pairs."""
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in (t.split() for t in texts)]
    first = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            same = len(sets[a] & sets[b])
            if sets[a] and 10 * same >= 8 * (len(sets[a]) + len(sets[b]) - same):
                low, high = sorted((first[a], first[b]))
                first = [low if x == high else x for x in first]
    return first


@pytest.mark.parametrize(("bucket", "sample"), [(32, 4096), (2, 16)])
def test_near_copies_against_a_five_word_brute_force(spark, monkeypatch, bucket, sample):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", bucket)
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", sample)
    rnd = random.Random(bucket)
    base = [f"b{i}" for i in range(100)]
    texts = [" ".join(base), " ".join(base + [f"c{i}" for i in range(18)])]  # 96/114, but 97/115 by four words
    other = [f"o{i}" for i in range(100)]
    texts += [" ".join(other), " ".join(other + [f"p{i}" for i in range(24)]), " ".join(other + [f"q{i}" for i in range(25)])]  # 0.8 and under
    for _ in range(30):
        words = rnd.choices([f"w{i}" for i in range(200)], k=rnd.randint(1, 80))
        texts.append(" ".join(words))
        for share in (0.01, 0.02, 0.04, 0.08):
            texts.append(" ".join("zz" if rnd.random() < share else w for w in words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()}
    assert found == set(five_word_groups(texts))
    assert 1 not in found and 3 not in found and 4 in found


def test_near_copies_counts_the_shingles_of_all_documents(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE_DOCS", 8)
    tables = []
    frequent = jaccard._frequent
    monkeypatch.setattr(jaccard, "_frequent", lambda *a: tables.append(frequent(*a)) or tables[-1])
    texts = [f"x{i} y{i} z{i} u{i} v{i}" + " a phrase of five words" * (i % 2) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert corpus_pipeline.near_copies(spark, docs, "").count() == 120
    assert tables[0].max() == 60 and (tables[0] > 0).sum() == 1


CLASHING = ["_spans", "_found_email", "found_email", "_matches", "matches", "spans", "row", "value", "_key", "doc", "gone"]


def test_documents_with_the_operators_own_names_go_through_every_stage(spark, small, tmp_path):
    folder, _ = small
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    added = [name for name in CLASHING if name not in docs.columns]
    clashing = docs.select("*", *[F.concat(F.lit(f"{name} "), F.col("doc_id")).alias(name) for name in added])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = stage(spark, docs, folder)
        wide = stage(spark, clashing, folder)
        assert wide.dtypes == clashing.dtypes, name
        # Of rows that share an id, hashes of all columns choose; ids and how often they stay are the same.
        ids = [Counter(r.doc_id for r in frame.select("doc_id").collect()) for frame in (wide, plain)]
        assert ids[0] == ids[1], name
        for column in added:
            assert wide.where(F.col(column) != F.concat(F.lit(f"{column} "), F.col("doc_id"))).count() == 0


def test_without_labels_texts_without_letters_still_go(spark):
    rows = [(1, "some text", None), (2, None, None), (3, " 12 !", None), (4, "", None), (5, "\u65e5\u672c", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5] and kept.dtypes == docs.dtypes


def test_scratch_tables_go_with_their_stage(spark, small):
    folder, _ = small
    before = set(below(spark))
    result = corpus_pipeline.run(spark, folder)
    left = set(below(spark)) - before
    assert len(left) == 1 and result.count() > 0
    assert all(name.startswith("pipeline") for name in left)
    (root,) = left
    assert children(spark, f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{root}") == ["pieces"]


def below(spark):
    return children(spark, f"{scratch_root(spark)}/{spark.sparkContext.applicationId}")


ONE_DAEMON = """
import sys
import psutil
from pyspark.sql import SparkSession
import corpus_pipeline as pipeline

folder = sys.argv[1]
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
read = f"{folder}/documents.parquet"
for name, stage in pipeline.STAGES:
    stage(spark, spark.read.parquet(read), folder).write.parquet(read := f"{folder}/one_daemon/{name}")
java = psutil.Process(spark.sparkContext._gateway.proc.pid)
print("DAEMONS", sum("pyspark.daemon" in " ".join(p.cmdline()) for p in java.children()))
"""


def test_stages_share_one_set_of_python_workers(small):
    """Of every environment and kind of worker an executor keeps a daemon, and its workers for a minute."""
    here = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    environment = os.environ | {"PYTHONPATH": os.pathsep.join(filter(None, [here, os.environ.get("PYTHONPATH")]))}
    ran = subprocess.run(
        [sys.executable, "-c", ONE_DAEMON, small[0]], env=environment, capture_output=True, text=True, timeout=300
    )
    assert ran.returncode == 0, ran.stderr[-2000:]
    assert ran.stdout.split("DAEMONS")[1].split() == ["1"]
