import itertools

import duckdb
import pytest
from helpers import components, odd_documents

import corpus_pipeline
from sparkreel.llm import pii, queries

SF = "/root/testdata/sf0.001"


def one_of_each_group(texts):
    """The least id of each group linked by five-word shingles with Jaccard >= 0.8, by comparing all pairs."""
    sets = {}
    for i, text in texts.items():
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    alike = lambda a, b: a == b or 5 * len(a & b) >= 4 * len(a | b) > 0
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if alike(sets[a], sets[b])]
    return {i for i, least in components(sets, links).items() if i == least}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF).cache()
        now = {r["doc_id"] for r in docs.collect()}
        assert docs.columns == columns and now <= ids, name
        if name == "near_duplicates":
            assert now == one_of_each_group({r["doc_id"]: r["text"] for r in before.collect()})
        if name == "personal_data":
            assert {r["doc_id"]: r["text"] for r in docs.collect()} == {r["doc_id"]: pii.pseudonymise(r["text"], pii.session_key(spark))[0] for r in before.collect()}
        ids = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == ids
    whole = corpus_pipeline.run(spark, SF)
    assert whole.select("doc_id", "piece", "length", "ids_crc32").exceptAll(packed.select("doc_id", "piece", "length", "ids_crc32")).count() == 0


def test_stages_take_odd_and_empty_rows(spark):
    odd = odd_documents(spark, names=True)
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, odd, SF).collect()
        assert stage(spark, odd.limit(0), SF).count() == 0
        if name != "pack_sequences":
            own = {repr([x for c, x in r.asDict().items() if c != "text"]) for r in odd.collect()}
            assert rows and all(r.__fields__ == odd.columns and repr([x for c, x in r.asDict().items() if c != "text"]) in own for r in rows) or name.startswith("quality"), name


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("embeddings", "pages", "documents", "benchmark"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = db.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF)
    assert sorted(map(repr, (tuple(r) for r in got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_names():
    assert [n.split("_")[0] for n in queries.queries()] == [f"op{n}" for n in range(1, 14)]


def test_near_duplicates_leave_one_row_of_each_group(spark):
    """Repeated rows and rows without a doc_id are deduplicated too."""
    text = " ".join(f"w{i}" for i in range(40))
    near, other = text + " w40", " ".join(f"x{i}" for i in range(30))
    rows = [(3, text, "a"), (3, text, "a"), (5, near, "b"), (None, text, "c"), (None, other, "d"), (None, other, "e"), (7, None, "f"), (None, "", "g"), (9, "lone", "h"), (3, other + " y z", "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `sp ace` string").repartition(3)
    left = sorted(map(tuple, corpus_pipeline.near_duplicates(spark, docs, SF).collect()), key=repr)
    assert left == sorted([(3, text, "a"), (3, other + " y z", "i"), (7, None, "f"), (9, "lone", "h")], key=repr)
    nameless = docs.where("doc_id is null")
    assert sorted(r["sp ace"] in "cdeg" and r["text"] for r in corpus_pipeline.near_duplicates(spark, nameless, SF).collect()) == sorted(["", text, other])
